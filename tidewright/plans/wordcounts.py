"""Word count and text sources over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions.text import WHITE_SPACE, java_split, words
from tidewright.operators import shaping
from tidewright.operators.wordcount import word_count
from tidewright.plans.registry import query
from tidewright.session import new_dir
from tidewright.sinks.files import as_text
from tidewright.sources.bounded import text_lines
from tidewright.sources.streams import arriving, file_tail, text_stream
from tidewright.streaming.state import kept_in_state
from tidewright.streaming.tables import Folder

SPLIT = """case when {t} <> '' and rtrim({t}, ' ') = '' then [] else string_split(rtrim({t}, ' '), ' ') end"""
WORDS = f"select unnest({SPLIT.format(t='text')}) as word from documents"
COUNTS = f'select word, count(*) as "count" from ({WORDS}) group by word'
LINES = """select case when ends_with(value, chr(13)) then substr(value, 1, length(value) - 1) else value end as value
  from (select unnest(string_split(text, chr(10))) as value from documents)"""
LINE_COUNTS = f"""select word, count(*) as "count" from (
  select unnest({SPLIT.format(t='value')}) as word from ({LINES})) group by word"""


def lines_folder(t) -> str:
    """The document lines as text files in the shared folder, for the text sources to read."""
    return as_text(t.documents.select("text"), new_dir(t.spark, "lines"))


@query("wordcount_batch", COUNTS)
def wordcount_batch(t):
    return word_count(t.documents, "text")


@query("wordcount_unified", COUNTS)
def wordcount_unified(t):
    """The batch form and the stream form are the same function; here on a table."""
    return word_count(t.documents.select(F.col("text").alias("value")))


@query("wordcount_stream", COUNTS)
def wordcount_stream(t):
    """Counts kept over four batches of documents."""
    documents = t.documents.select("doc_id", "text")
    end = documents.agg(F.max("doc_id")).first()[0] + 1
    stream = arriving(documents, F.floor(F.col("doc_id") * 4 / end), 4).select(F.col("text").alias("value"))
    return kept_in_state(word_count(stream), new_dir(t.spark, "wordcount"))


@query("flatmap_words", WORDS)
def flatmap_words(t):
    return words(t.documents, "text")


@query("map_pair_one", f"select word, 1 as one from ({WORDS})")
def map_pair_one(t):
    return shaping.pair_with_one(words(t.documents, "text"), "word")


@query("fn_split", f"select doc_id, len({SPLIT.format(t='text')}) as n_words from documents")
def fn_split(t):
    return t.documents.select("doc_id", F.size(java_split(F.col("text"))).cast("long").alias("n_words"))


@query("src_text", LINES)
def src_text(t):
    return text_lines(t.spark, lines_folder(t))


@query("src_text_once", LINE_COUNTS)
def src_text_once(t):
    return kept_in_state(word_count(text_stream(t.spark, lines_folder(t))), new_dir(t.spark, "once"))


@query("src_text_continuous", LINE_COUNTS)
def src_text_continuous(t):
    """A 2 s trigger that would go on for ever; stopped here once it has read the files there are."""
    counts = word_count(text_stream(t.spark, lines_folder(t)))
    return kept_in_state(counts, new_dir(t.spark, "continuous"), {"processingTime": "2 seconds"})


def eighth(t, folder: str) -> int:
    """Files per batch, for about eight batches whatever the number of files."""
    return max(sum(name.startswith("part-") for name in Folder(t.spark, folder).names()) // 8, 1)


@query("src_socket_text", LINE_COUNTS)
def src_socket_text(t):
    """The socket word count; the lines come from a file stream, since no port is opened."""
    folder = lines_folder(t)
    return kept_in_state(word_count(text_stream(t.spark, folder, eighth(t, folder))), new_dir(t.spark, "socket"))


@query("src_file_tail", f"""select word, count(*) as "count" from (
  select unnest({SPLIT.format(t='value')}) as word from ({LINES})
  where regexp_replace(value, '{WHITE_SPACE}', '', 'g') <> '') group by word""")
def src_file_tail(t):
    """A few files per batch, blank lines left out."""
    folder = lines_folder(t)
    return kept_in_state(word_count(file_tail(t.spark, folder, eighth(t, folder))), new_dir(t.spark, "tail"))


@query("sink_text", LINES)
def sink_text(t):
    return text_lines(t.spark, as_text(t.documents.select("text"), new_dir(t.spark, "text")))
