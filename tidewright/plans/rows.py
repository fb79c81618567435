"""Row-wise operators and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions import scalars, text
from tidewright.operators import lookup, rolling, shaping
from tidewright.plans.registry import query

LOG = """select concat_ws(' ', '10.0.' || (user_id % 7) || '.' || (event_id % 11), cast(user_id as varchar),
  strftime(ts, '%d/%m/%Y:%H:%M:%S'), upper(event_type), '/p/' || event_id) as line from events"""


def log_lines(t):
    """Log lines put together from the events."""
    number = lambda c, n: (F.col(c) % n).cast("string")
    return t.events.select(
        F.concat_ws(
            " ",
            F.concat(F.lit("10.0."), number("user_id", 7), F.lit("."), number("event_id", 11)),
            F.col("user_id").cast("string"),
            F.date_format("ts", scalars.LOG_TIME),
            F.upper("event_type"),
            F.concat(F.lit("/p/"), F.col("event_id").cast("string")),
        ).alias("line")
    )


@query("map_parse_log", f"""select split_part(line, ' ', 1) as ip, cast(split_part(line, ' ', 2) as integer) as user_id,
  epoch_ms(strptime(split_part(line, ' ', 3), '%d/%m/%Y:%H:%M:%S')) as ts,
  split_part(line, ' ', 4) as "method", split_part(line, ' ', 5) as path from ({LOG})""")
def map_parse_log(t):
    return shaping.parse_log(log_lines(t), "line")


CSV = "select concat_ws(',', event_type, cast(event_id as varchar), cast(value as varchar)) as line from events"


@query("map_parse_csv", f"""select split_part(line, ',', 1) as k, cast(split_part(line, ',', 2) as bigint) as n,
  cast(split_part(line, ',', 3) as double) as v from ({CSV})""")
def map_parse_csv(t):
    lines = t.events.select(F.concat_ws(",", "event_type", F.col("event_id").cast("string"), F.col("value").cast("string")).alias("line"))
    return shaping.parse_fields(lines, "line", {"k": "string", "n": "bigint", "v": "double"})


@query("flatmap_unpivot", """select unnest([p_name || 'hive' || p_brand, p_name || 'hive' || p_type,
  p_name || 'hive' || cast(p_size as varchar)]) as pair from part""")
def flatmap_unpivot(t):
    parts = t.part.withColumn("p_size", F.col("p_size").cast("string"))
    return shaping.unpivot_pairs(parts, "p_name", ["p_brand", "p_type", "p_size"], "hive")


@query("filter_contains", "select page_id, url from pages where contains(url, 'example.com')")
def filter_contains(t):
    return shaping.contains(t.pages.select("page_id", "url"), "url", "example.com")


@query("filter_compare", "select event_id, value from events where value > 8")
def filter_compare(t):
    return shaping.above(t.events.select("event_id", "value"), "value", 8)


@query("filter_malformed", """with lines as (select case event_id % 5 when 0 then event_type || ',x' || event_id
    when 1 then event_type when 2 then 'null,' || event_id when 3 then event_type || ',0'
    else event_type || ',' || event_id end as line from events),
  parsed as (select split_part(line, ',', 1) as word, try_cast(split_part(line, ',', 2) as bigint) as ts from lines)
  select word, ts from parsed where ts is not null and ts <> 0 and word <> 'null'""")
def filter_malformed(t):
    kind, number, n = F.col("event_type"), F.col("event_id").cast("string"), F.col("event_id") % 5
    line = (
        F.when(n == 0, F.concat(kind, F.lit(",x"), number))
        .when(n == 1, kind)
        .when(n == 2, F.concat(F.lit("null,"), number))
        .when(n == 3, F.concat(kind, F.lit(",0")))
        .otherwise(F.concat(kind, F.lit(","), number))
    )
    return shaping.drop_malformed(t.events.select(line.alias("line")), "line")


@query("split_side_output", """select tag, count(*) as n, sum(o_orderkey)::bigint as keys from (
  select o_orderkey, case when o_orderkey % 2 = 0 then 'even' else 'odd' end as tag from orders) group by tag""")
def split_side_output(t):
    """Both side outputs, each summed up on its own."""
    tagged = shaping.tag_parity(t.orders.select("o_orderkey"), "o_orderkey")
    sums = [
        shaping.side_output(tagged, tag).groupBy(F.lit(tag).alias("tag")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")
        )
        for tag in ("odd", "even")
    ]
    return rolling.union_all(*sums)


@query("connect_comap", """select 1 as side, 'customer ' || c_name as name, null::double as balance from customer
  union all select 2, null, s_acctbal from supplier""")
def connect_comap(t):
    return shaping.connect(
        t.customer, t.supplier,
        [F.concat(F.lit("customer "), "c_name").alias("name")],
        [F.col("s_acctbal").alias("balance")],
    )


@query("iterate_until", """select p_partkey,
  case when p_size > 0 then -(p_size % 2) else p_size - 2 end as p_size from part""")
def iterate_until(t):
    return shaping.iterate_until(t.part.select("p_partkey", "p_size"), "p_size", lambda v: v - 2, lambda v: v > 0)


@query("union_all", """select c_name as name, c_acctbal as balance from customer
  union all select s_name, s_acctbal from supplier union all select s_name, s_acctbal from supplier""")
def union_all(t):
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return rolling.union_all(customers, suppliers, suppliers)


@query("fn_trim", r"""select doc_id, regexp_replace(regexp_replace(chr(9) || text || chr(10), '^[\x00-\x20]+', ''),
  '[\x00-\x20]+$', '') as trimmed from documents""")
def fn_trim(t):
    padded = F.concat(F.lit("\t"), F.col("text"), F.lit("\n"))
    return t.documents.select("doc_id", text.java_trim(padded).alias("trimmed"))


@query("fn_contains", "select page_id, contains(url, 'ref=') as has from pages")
def fn_contains(t):
    return t.pages.select("page_id", F.col("url").contains("ref=").alias("has"))


@query("fn_starts_with", "select page_id, starts_with(url, 'https') as has from pages")
def fn_starts_with(t):
    return t.pages.select("page_id", F.col("url").startswith("https").alias("has"))


@query("fn_is_blank", f"""select doc_id, count(*) filter (where regexp_replace(line, '{text.WHITE_SPACE}', '', 'g') = '') as blank_lines
  from (select doc_id, unnest(string_split(text, chr(10))) as line from documents) group by doc_id""")
def fn_is_blank(t):
    lines = t.documents.select("doc_id", F.split("text", "\n").alias("lines"))
    return lines.select("doc_id", F.size(F.filter("lines", text.is_blank)).cast("long").alias("blank_lines"))


@query("fn_concat", "select c_custkey, c_name || '/' || c_mktsegment as label from customer")
def fn_concat(t):
    return t.customer.select("c_custkey", F.concat("c_name", F.lit("/"), "c_mktsegment").alias("label"))


K = """regexp_extract(props, '[0-9]+')"""


@query("fn_parse_int", f"select event_id, cast({K} as integer) as k from events")
def fn_parse_int(t):
    return t.events.select("event_id", scalars.parse(F.regexp_extract("props", "[0-9]+", 0), "int").alias("k"))


@query("fn_parse_long", f"select event_id, cast({K} || '00000000000' as bigint) as k from events")
def fn_parse_long(t):
    digits = F.concat(F.regexp_extract("props", "[0-9]+", 0), F.lit("00000000000"))
    return t.events.select("event_id", scalars.parse(digits, "bigint").alias("k"))


@query("fn_parse_double", f"select event_id, cast({K} || '.25' as double) as k, try_cast('x' || {K} as double) as bad from events")
def fn_parse_double(t):
    digits = F.regexp_extract("props", "[0-9]+", 0)
    return t.events.select(
        "event_id",
        scalars.parse(F.concat(digits, F.lit(".25")), "double").alias("k"),
        scalars.parse(F.concat(F.lit("x"), digits), "double", strict=False).alias("bad"),
    )


@query("fn_parse_ts", """select event_id, epoch_ms(strptime(strftime(ts, '%d/%m/%Y:%H:%M:%S'), '%d/%m/%Y:%H:%M:%S')) as ms from events""")
def fn_parse_ts(t):
    return t.events.select("event_id", scalars.parse_time(F.date_format("ts", scalars.LOG_TIME)).alias("ms"))


@query("fn_format_ts", """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.') || substr(strftime(ts, '%f'), 1, 3) as label from events""")
def fn_format_ts(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select("event_id", scalars.format_time(ms).alias("label"))


@query("fn_mod", """select l_orderkey, l_linenumber, l_orderkey % 2 as parity, l_orderkey - 2 as less,
  greatest(l_quantity, l_tax * 100) as largest from lineitem""")
def fn_mod(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 2).alias("parity"),
        (F.col("l_orderkey") - 2).alias("less"),
        scalars.largest(F.col("l_quantity"), F.col("l_tax") * 100).alias("largest"),
    )


@query("fn_get_or_default", "select event_id, coalesce(case when value > 50 then event_type end, 'unknown') as kind from events")
def fn_get_or_default(t):
    kind = scalars.get_or_default(F.when(F.col("value") > 50, F.col("event_type")), "unknown")
    return t.events.select("event_id", kind.alias("kind"))


@query("fn_random", "select event_id, true as in_range from events")
def fn_random(t):
    return t.events.select("event_id", scalars.random_int(1000).between(0, 999).alias("in_range"))


@query("fn_uuid", "select event_id, true as well_formed from events")
def fn_uuid(t):
    shape = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return t.events.select("event_id", scalars.random_uuid().rlike(shape).alias("well_formed"))


@query("fn_now_ms", "select event_id, true as after_the_event from events")
def fn_now_ms(t):
    event = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select("event_id", (scalars.now_ms() > event).alias("after_the_event"))


# What stands for the name of a key that a dimension does not have.
UNKNOWN = "未知"
UNKNOWN_STUDENT = "未知学生姓名"


@query("broadcast_lookup", f"""select l_orderkey, l_linenumber, l_quantity, coalesce(p.p_name, '{UNKNOWN}') as p_name
  from lineitem l left join (select * from part where p_size <= 40) p on l.l_partkey = p.p_partkey""")
def broadcast_lookup(t):
    """Parts over size 40 are not in the dimension; every part is put twice, the later one wins."""
    parts = t.part.where(F.col("p_size") <= 40).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    puts = parts.withColumn("put", F.lit(2)).unionByName(parts.select("id", F.lit("old").alias("name"), F.lit(1).alias("put")))
    scores = t.lineitem.select(F.col("l_partkey").alias("id"), "l_orderkey", "l_linenumber", "l_quantity")
    named = lookup.lookup(scores, lookup.last_put_wins(puts, "id", "put"), "id", "name", UNKNOWN)
    return named.select("l_orderkey", "l_linenumber", "l_quantity", F.col("name").alias("p_name"))


@query("cache_file_lookup", f"""select c_custkey, coalesce(n_name, '{UNKNOWN_STUDENT}') as n_name from customer
  left join (select * from nation where n_regionkey <> 1) on c_nationkey = n_nationkey""")
def cache_file_lookup(t):
    """The dimension is a comma-separated file, made here from ``nation``."""
    from tidewright.session import new_dir
    from tidewright.sinks.files import as_csv

    nations = t.nation.where(F.col("n_regionkey") != 1).select("n_nationkey", "n_name")
    path = as_csv(nations, new_dir(t.spark, "dimension"))
    dimension = lookup.file_dimension(t.spark, path, "id int, n_name string", ",")
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("id"))
    return lookup.lookup(customers, dimension, "id", "n_name", UNKNOWN_STUDENT).select("c_custkey", "n_name")
