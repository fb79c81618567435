"""Similarity join of documents on the Jaccard index of their word shingles, by a token-group matrix.

Similar documents are put into groups of bounded size. The matrix says which tokens a group holds, so that the overlap
of a document with a whole group can be bounded, and only groups that qualify are opened and compared exactly.

Tokens have a global order. Two sets that link share one of the first ``n - ceil(share * n) + 1`` tokens of each (the
prefix), whatever the order, so the matrix holds prefixes only and loses no link. The order puts a fixed part of all
tokens, chosen by hash, first, and of these the rare ones first; prefixes then lie in that part, only its tokens are
counted, and a document drops out as soon as its prefix holds nothing but tokens of its own. Equal sets are one set. What is
linked within its group is one component from then on, and only documents of different components are compared further.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidewright.llm.common import batch, by_group, map_batches, mixed, shingle_hashes, signed, stretches, lists, word_hashes
from tidewright.llm.graph import components
from tidewright.session import discard, materialise

#: Per cent of the union that two sets share to link; words in a shingle.
PERCENT, SHINGLE = 75, 5
#: One row in so many shows which tokens are frequent, and so many of these are kept. Both set only the order of tokens.
SAMPLE, FREQUENT = 64, 1 << 16
#: Two fifths of all tokens are counted. Counts from here on rank alike; frequent tokens rank higher.
COUNTED, RARE = 2, 111
#: Prefixes are longer by this part of a set: one token in common is not enough then to ask a group.
MORE = 0.05
#: Tokens that are counted together on average.
BUCKET = 1 << 20
#: Sets and tokens of a group; queries that a group is opened for at a time.
GROUP_SETS, GROUP_TOKENS, QUERIES = 256, 1 << 20, 4096
#: Documents whose places are broadcast; more are joined by a shuffle.
PLACES = 1_000_000


def _sets(texts: pa.Array):
    """For stretches of rows: the first row, the distinct shingle hashes of all its rows, sorted within a row, and where each row begins."""
    for a, b, data, places in stretches(texts):
        words, rows = word_hashes(data, places)
        found, begin = shingle_hashes(words, rows, SHINGLE)
        for i, j in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            found[i:j].sort()
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        new[begin[:-1][np.diff(begin) > 0]] = True
        yield a, found[new], np.concatenate([[0], np.cumsum(new)])[begin]


def _marks(tokens: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """Two numbers for each row that stand for its set of tokens."""
    out = []
    for c in (0x51ED270B, 0xA24BAED4963EE407):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(tokens ^ np.uint64(c)), dtype=np.uint64)])
        out.append(signed(sums[begin[1:]] - sums[begin[:-1]]))
    return out


def _codes(tokens: np.ndarray) -> np.ndarray:
    """Whether a token is outside the counted part (bit 62), and 55 bits of it, which is a hash itself."""
    return (tokens % np.uint64(5) >= COUNTED).astype(np.uint64) << np.uint64(62) | tokens >> np.uint64(9)


def _needed(n, percent: int):
    """Tokens in the prefix of a set of ``n``."""
    return n - (percent * n + 99) // 100 + 1


def _step(n, percent: int):
    """Size class of a set; sets that link are in one class or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")


def _more(step, percent: int):
    """Tokens by which prefixes of a size class are longer, so that sets that link share one more than that."""
    return F.floor(F.pow(F.lit(100.0 / percent), step) * MORE).cast("int")


def frequent_tokens(documents: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[np.ndarray, np.ndarray]:
    """Codes of the most frequent tokens of a sample of rows, in order, and a rank of how often they occur in it."""
    rows = documents.where(F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(SAMPLE)) == 0).select(F.col(f"`{text}`").alias("text"))

    def run(part: pa.RecordBatch):
        for _, tokens, _ in _sets(part.column("text")):
            found, c = np.unique(_codes(tokens), return_counts=True)
            yield [signed(found), c]

    counts = map_batches(rows, run, "token long, c long").groupBy("token").agg(F.sum("c").alias("c")).where("c > 1")
    top = counts.orderBy(F.desc("c"), "token").limit(FREQUENT).toArrow()
    code, c = np.asarray(top.column("token"), np.int64).view(np.uint64), np.asarray(top.column("c"), np.int64)
    order = np.argsort(code)
    return code[order], np.minimum(RARE + 1 + np.log2(np.maximum(c[order], 1)).astype(np.int64), 127).astype(np.uint64)


def _leading(tokens: np.ndarray, begin: np.ndarray, frequent, percent: int):
    """Codes that the prefix of each row may hold, and their rows: those to be counted, then the frequent ones with their rank.

    These are all of the counted part and, if they are too few for the prefix, the next by hash.
    """
    often, rank = frequent
    n = np.diff(begin)
    codes = _codes(tokens)
    outer = codes >> np.uint64(62) != 0
    inner = np.concatenate([[0], np.cumsum(~outer)])
    lack = np.where(n > 0, _needed(n, percent) + (MORE * n).astype(np.int64), 0) - np.diff(inner[begin])
    before = np.arange(len(codes)) - inner[:-1] - np.repeat(begin[:-1] - inner[begin[:-1]], n)
    take = ~outer | (before < np.repeat(lack, n))
    codes, row = codes[take], np.repeat(np.arange(len(n)), n)[take]
    if not len(often):
        return codes, row, codes[:0], row[:0]
    at = np.minimum(np.searchsorted(often, codes), len(often) - 1)
    is_often = often[at] == codes
    ranked = codes[is_often]
    ranked = np.where(ranked >> np.uint64(62), ranked, ranked | rank[at[is_often]] << np.uint64(55))
    return codes[~is_often], row[~is_often], ranked, row[is_often]


def fingerprints(documents: DataFrame, frequent, text: str = "text", key: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """``id``, ``n`` distinct shingles, two marks of the set, how many tokens are counted, and its frequent tokens."""
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))

    def run(part: pa.RecordBatch):
        for a, tokens, begin in _sets(part.column("text")):
            n = len(begin) - 1
            _, row, ranked, of_row = _leading(tokens, begin, frequent, percent)
            ends = np.concatenate([[0], np.cumsum(np.bincount(of_row, minlength=n))])
            yield [
                part.column("id").slice(a, n), np.diff(begin), *_marks(tokens, begin), np.bincount(row, minlength=n),
                lists(signed(ranked), ends, pa.int64()),
            ]

    return map_batches(rows, run, "id long, n long, m1 long, m2 long, counted long, frequent array<long>")


def _blocks(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """Runs of 64-bit numbers as an Arrow binary column."""
    return pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer((8 * begin).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _counted(documents: DataFrame, frequent, text: str, key: str, percent: int, total: int) -> DataFrame:
    """``id`` and ``token`` for each token that is to be counted and that several rows have, with its count in its rank.

    The ``total`` tokens are dealt by hash into buckets of about ``BUCKET``, as blocks of a bucket for each stretch of rows. None of
    them is frequent, so no bucket is hot.
    """
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).where("id is not null")
    buckets = max(1, -(-total // BUCKET))

    def deal(part: pa.RecordBatch):
        ids = np.asarray(part.column("id"))
        codes, of = [], []
        for a, tokens, begin in _sets(part.column("text")):
            code, row, _, _ = _leading(tokens, begin, frequent, percent)
            codes.append(code)
            of.append(ids[a + row])
        codes, of = np.concatenate([np.zeros(0, np.uint64), *codes]), np.concatenate([np.zeros(0, np.int64), *of])
        bucket = (codes % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        names, at = np.unique(bucket[order], return_index=True)
        at = np.append(at, len(order))
        yield [names, _blocks(codes[order], at), _blocks(of[order], at)]

    kinds = T.StructType.fromDDL("id long, token long")

    def count(parts):
        for table in by_group(parts, ("bucket",)):
            code, of = (np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for chunk in table.column(c).chunks for x in chunk]) for c in ("codes", "ids"))
            order = np.argsort(code)
            code = code[order]
            head = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            c = np.diff(np.append(head, len(code)))
            c = np.repeat(c, c)
            several = c > 1
            code, c = code[several], c[several]
            yield batch(kinds, [of[order][several], np.where(code >> 62 != 0, code, code | np.minimum(c, RARE) << 55)])

    blocks = map_batches(rows, deal, "bucket int, codes binary, ids binary")
    return blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, kinds)


def _prefixes(documents: DataFrame, prints: DataFrame, frequent, text: str, key: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """``token`` and ``id``: the tokens of each prefix that may be shared, of documents that may link; and the table they are read from.

    The tokens go through one shuffle, in which each is counted. Frequent ones stay out of it, so no token is hot there.
    """
    total = prints.where("id is not null").agg(F.coalesce(F.sum("counted"), F.lit(0))).first()[0]
    found = materialise(_counted(documents, frequent, text, key, percent, total), "counted")
    own = found.groupBy("id").agg(F.count("*").alias("shared"))
    sets = prints.where("n > 0 and id is not null").groupBy("id").agg(F.max("n").alias("n"), F.min("counted").alias("counted"), F.max(F.size("frequent")).alias("often"))
    needed = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    take = needed - F.col("counted") + F.coalesce("shared", F.lit(0))
    there = F.coalesce("shared", F.lit(0)) + F.col("often")
    more = _more(_step(F.col("n"), percent), percent)
    take = sets.join(own, "id", "left").where((take > 0) & (there > more)).select("id", (take + more).alias("take"))
    often = prints.where("n > 0 and id is not null").select("id", F.explode("frequent").alias("token"))
    place = F.dense_rank().over(Window.partitionBy("id").orderBy("token"))
    return found.union(often).join(take, "id").withColumn("place", place).where(F.col("place") <= F.col("take")).select("id", "token"), found


class _Group:
    """The sets of a group with the column of the token-group matrix that the group has: all its tokens."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        self.members = np.repeat(np.arange(len(sets)), self.size)[order]
        self.tokens, self.begin = np.unique(every[order], return_index=True)
        self.begin = np.append(self.begin, len(every))

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Which members link with ``query``; the group is opened only if enough of its tokens are there."""
        none = np.zeros(0, np.int64)
        if not len(query) or not len(self.tokens):
            return none
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        if 100 * len(at) < percent * len(query):
            return none
        n = self.begin[at + 1] - self.begin[at]
        places = np.repeat(self.begin[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(self.members[places], minlength=len(self.size))
        return np.flatnonzero(100 * both >= percent * (len(query) + self.size - both))


def _tokens(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for chunk in table.column("tokens").chunks for x in chunk]


def _within(members: DataFrame, percent: int) -> DataFrame:
    """``id`` and a component of its group: the leader's id if it is linked to the leader there, else the smallest id.

    The leader of similar documents is a member of each of their groups, so these components meet in it.
    """
    kinds = T.StructType.fromDDL("id long, part long")

    def run(parts):
        for table in by_group(parts, ("home", "place")):
            ids, sets, leader = np.asarray(table.column("id")), _tokens(table), int(table.column("leader")[0].as_py())
            part = np.arange(len(ids))
            group = _Group(sets)
            for i in sorted(range(len(ids)), key=lambda i: (ids[i] != leader, ids[i])):
                if (part == part[0]).all():
                    break
                near = group.linked(sets[i], percent)
                part[np.isin(part, part[near])] = part[i]
            label = np.empty(len(ids), np.int64)
            for p in np.unique(part):
                own = ids[part == p]
                label[part == p] = leader if leader in own else own.min()
            yield batch(kinds, [ids, label])

    place = F.when(F.col("id") == F.col("leader"), F.sequence(F.lit(0).cast("long"), F.col("places") - 1)).otherwise(F.array("place"))
    rows = members.select("home", F.explode(place).alias("place"), "leader", "id", "tokens")
    return rows.repartition("home", "place").sortWithinPartitions("home", "place", "id").mapInArrow(run, kinds).distinct()


def _between(rows: DataFrame, percent: int) -> DataFrame:
    """Links of queries with members of another component, one for each component a query meets in a group."""
    kinds = T.StructType.fromDDL("a long, b long")

    def run(parts):
        for table in by_group(parts, ("home", "place", "turn")):
            query, ids, part, sets = np.asarray(table.column("query")), np.asarray(table.column("id")), np.asarray(table.column("part")), _tokens(table)
            own = np.flatnonzero(~query)
            group = _Group([sets[i] for i in own]) if len(own) else None
            a, b = [], []
            for i in np.flatnonzero(query) if group else []:
                near = own[group.linked(sets[i], percent)]
                near = near[part[near] != part[i]]
                _, first = np.unique(part[near], return_index=True)
                a += [ids[i]] * len(first)
                b += ids[near[first]].tolist()
            yield batch(kinds, [a, b])

    return rows.repartition("home", "place", "turn").sortWithinPartitions("home", "place", "turn", "query", "id").mapInArrow(run, kinds)


def similar_components(documents: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` of every row: the smallest id that links lead to, its own included.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, a set is the distinct five-word shingles, of fewer words the whole
    sequence. A null text and one without words have the empty set and link with nothing. A row with a null id has a null
    component and links with nothing. Rows with one id are one document: each has its own set, and they share a component.
    Equal sets always link. An empty table gives an empty result. Other columns are not read.

    Hot groups: equal sets meet in a sum per set before anything else; a token in very many documents comes last in the
    order; near copies, which share their most frequent token and are
    of like size, are cut into groups of at most ``GROUP_SETS`` sets or ``GROUP_TOKENS`` tokens on average, and what
    already is in the larger component never asks.
    """
    frequent = frequent_tokens(documents, text, key)
    prints = materialise(fingerprints(documents, frequent, text, key, percent), "sets")
    some = prints.where("n > 0 and id is not null")
    marks = ["n", "m1", "m2"]
    classes = some.groupBy(*marks).agg(F.min("id").alias("first"))
    of_class = materialise(prints.select("id", *marks).join(classes, marks, "left").select("id", *marks, F.when(F.col("id").isNotNull(), F.col("first")).alias("first")), "classes")
    known = of_class.where("first is not null")
    firsts = known.where("id = first").select("id", "n", "m1").distinct()

    prefix, counted = _prefixes(documents, prints, frequent, text, key, percent)
    shared = prefix.join(known.select("id", "first").distinct(), "id").select("token", F.col("first").alias("id")).distinct()
    leading = materialise(shared, "tokens")
    discard(counted, prints)
    twice = leading.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    shared = materialise(leading.join(twice, "token"), "tokens")
    discard(leading)

    often = F.struct((-F.shiftright("token", 62)).alias("o"), F.shiftright("token", 55).alias("r"), (-F.col("token")).alias("t"))
    sets = shared.groupBy("id").agg(F.max_by("token", often).alias("token"), F.count("*").alias("k")).join(firsts, "id")
    sets = sets.withColumn("step", _step(F.col("n"), percent)).withColumn("home", F.xxhash64("token", "step"))
    homes = sets.groupBy("home").agg(F.count("*").alias("sets"), F.sum("n").alias("size"), F.max(F.struct("k", (-F.col("id")).alias("i"))).alias("top"))
    homes = homes.select("home", (-F.col("top.i")).alias("leader"), F.greatest(F.ceil(F.col("sets") / GROUP_SETS), F.ceil(F.col("size") / GROUP_TOKENS)).alias("places"))
    places = materialise(
        sets.join(homes, "home").select("id", "m1", "home", "step", "leader", "places", F.pmod(F.xxhash64("id", F.lit(1)), F.col("places")).alias("place")), "places"
    )
    few = places.count() <= PLACES
    spot = places.drop("step").withColumnRenamed("id", "own")
    texts = documents.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    texts = texts.join(F.broadcast(spot) if few else spot, F.col("id") == F.col("own")).drop("own")

    def full(part: pa.RecordBatch):
        m1 = np.asarray(part.column("m1"))
        for a, tokens, begin in _sets(part.column("text")):
            right = np.flatnonzero(_marks(tokens, begin)[0] == m1[a : a + len(begin) - 1])
            taken = part.take(pa.array(a + right))
            yield [*(taken.column(c) for c in ("id", "home", "place", "places", "leader")), [tokens[begin[i] : begin[i + 1]].tobytes() for i in right]]

    members = materialise(map_batches(texts, full, "id long, home long, place long, places long, leader long, tokens binary"), "members")
    parts = materialise(_within(members, percent), "parts")

    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    spots = places.select("id", "home", "place", "step").distinct().join(parts, "id").join(sizes, "part")
    marked = shared.join(spots, "id").select("token", "id", "home", "place", "step", F.struct("size", "part").alias("rank"))
    mixed_tokens = marked.groupBy("token").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi")).where("lo < hi").select("token")
    marked = materialise(marked.join(mixed_tokens, "token"), "marked")
    discard(shared, places)
    matrix = marked.groupBy("token", "home", "place", "step").agg(F.max("rank").alias("rank"))
    matrix = matrix.groupBy("token").agg(F.collect_list(F.struct("home", "place", "step", "rank")).alias("groups"))
    asked = marked.join(matrix, "token").select(
        "id", "step", F.filter("groups", lambda g: (g["rank"] > F.col("rank")) & (F.abs(g["step"] - F.col("step")) <= 1) & ((g["home"] != F.col("home")) | (g["place"] != F.col("place")))).alias("groups")
    )
    asked = asked.where(F.size("groups") > 0).select("id", "step", F.transform("groups", lambda g: F.struct(g["home"].alias("home"), g["place"].alias("place"), g["step"].alias("step"))).alias("groups"))
    asked = asked.groupBy("id", "step").agg(F.flatten(F.collect_list("groups")).alias("groups"))
    enough = F.filter(
        F.array_distinct("groups"), lambda g: F.size(F.filter("groups", lambda x: x == g)) > _more(F.least(g["step"], F.col("step")), percent)
    )
    asked = materialise(asked.select("id", F.explode(enough).alias("g")).select("id", "g.home", "g.place"), "asked")
    discard(marked)

    turns = asked.groupBy("home", "place").agg(F.ceil(F.count("*") / QUERIES).alias("turns"))
    held = members.select("id", "tokens", "home", "place").join(parts, "id")
    queries = asked.join(held.select("id", "tokens", "part"), "id").join(turns, ["home", "place"])
    queries = queries.select("home", "place", F.pmod(F.xxhash64("id", F.lit(2)), F.col("turns")).alias("turn"), F.lit(True).alias("query"), "id", "part", "tokens")
    targets = held.join(turns, ["home", "place"]).select(
        "home", "place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("turn"), F.lit(False).alias("query"), "id", "part", "tokens"
    )
    links = _between(queries.union(targets), percent)

    several = known.select("id", "first").distinct().groupBy("id").agg(F.collect_set("first").alias("f")).where(F.size("f") > 1)
    links = links.union(parts).union(several.select("id", F.explode("f")))
    found = components(links).select(F.col("node").alias("first"), "component")
    discard(asked, members, parts)
    return of_class.join(found, "first", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "first", "id").alias("component_id")
    )


def one_of_each(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All columns of one document of each component, the one with the smallest id; rows without an id all stay.

    If several rows have that id, one of them stays: the one whose columns, read as a struct, are smallest.
    """
    names = documents.columns
    found = materialise(similar_components(documents, percent=percent), "components")
    per_id = found.where("id is not null").groupBy("id").agg(F.min("component_id").alias("component"), F.count("*").alias("rows"))
    leave = materialise(per_id.where("id <> component or rows > 1").select(F.col("id").alias("__id"), (F.col("id") == F.col("component")).alias("__stays")), "left")
    hint = F.broadcast if leave.count() <= PLACES else lambda df: df
    once = documents.join(hint(leave), documents["doc_id"] == leave["__id"], "left_anti")
    again = documents.join(hint(leave.where("__stays")), documents["doc_id"] == leave["__id"])
    again = again.groupBy("__id").agg(F.min(F.struct(*(documents[n] for n in names))).alias("row")).select("row.*")
    return once.unionByName(again)
