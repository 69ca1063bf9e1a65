"""Quality rules, in DataFrame and SQL functions only: base rules of each text, then cross-document line frequency.

Words are runs of characters other than space and 0x09 to 0x0D. The base rules need nothing but a text:
how many words, symbols, repeated lines and words in repeated runs of eight it has. Line frequency looks
across documents: lines are normalised (A-Z folded, digits made 0, white space made one space), hashed,
and counted by how many distinct documents of a host hold them; lines in more than `most_docs` and more
than `most_share` of a host's documents are removed, and a document is depleted, and rejected, if fewer
than `least_words` words or `least_left` of its words are left.

The texts are read once: what the base rules and the lines of a document come to is stored, and both the
frequency table and the join on it are made from that. They carry hashes and word counts but no text, and a
hot host or line is summed in each task before it is shuffled.

Edge cases: a null text has no words and no lines; null hosts are one host of their own; blank lines
don't count; repeated rows of one document count once for a line and each get a row; documents with a
null id count for no line and lose none; an empty table gives no rows; very long texts take time in
proportion to their length; further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import stored, table

#: White space within a line.
BLANKS = " \t\x0b\x0c\r"
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _replaced(text: Column, characters: str, by: str) -> Column:
    """Each of some characters replaced; where there are few to find, much faster than translate()."""
    return reduce(lambda out, c: F.replace(out, F.lit(c), F.lit(by)), characters, text)


def words(text: Column) -> Column:
    """Runs of characters other than space and 0x09 to 0x0D."""
    return F.filter(F.split(_replaced(text, BLANKS[1:] + "\n", " "), " "), lambda x: x != "")


def with_lines(rows: DataFrame) -> DataFrame:
    """Adds lines: of each line of the column own its hash after A-Z are folded, runs of digits made 0 and white space made one space, and its number of words; blank lines have none."""
    own = F.col("own")
    plain = F.when(F.octet_length(own) == F.length(own), F.lower(own)).otherwise(F.translate(own, _UPPER, _LOWER))  # lower() of ASCII folds A-Z alone
    rows = rows.withColumn("plain", _replaced(F.regexp_replace(plain, "[0-9]+", "0"), BLANKS[1:], " "))
    rows = rows.withColumn("plain", F.when(F.contains("plain", F.lit("  ")), F.regexp_replace("plain", "  +", " ")).otherwise(F.col("plain")))
    # words are one more than the spaces that are left
    line = lambda x: F.struct(F.xxhash64(x).alias("line_hash"), F.when(x == "", 0).otherwise(F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("line_words"))
    return rows.withColumn("lines", F.transform(F.transform(F.split("plain", "\n"), lambda x: F.trim(x)), line)).drop("plain")


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words from the column codes, hashes of the words.

    Hashes of 2, 4 and 8 words are made from those of half as many; where no run of four words occurs twice, no window does.
    The last hashes are of fewer words and only tell that more has to be looked at.
    """
    # each column is used twice below where a lambda uses it, else the optimiser would put its making into the lambda
    for k in (1, 2):
        rows = rows.withColumn(f"runs_{2 * k}", F.expr(f"transform(runs_{k}, (x, i) -> xxhash64(x, get(runs_{k}, i + {k})))")).drop(f"runs_{k}")
    again = f"size(runs_4) >= {WINDOW} AND size(array_distinct(runs_4)) < size(runs_4)"
    rows = rows.withColumn("windows", F.expr(f"CASE WHEN {again} THEN slice(transform(runs_4, (x, i) -> xxhash64(x, get(runs_4, i + 4))), 1, size(runs_4) - {WINDOW - 1}) ELSE array() END")).drop("runs_4")
    rows = rows.withColumn("found", F.expr("CASE WHEN size(array_distinct(windows)) < size(windows) THEN sort_array(transform(windows, (h, i) -> struct(h, i))) ELSE array() END")).drop("windows")
    rows = rows.withColumn("at", F.expr("CASE WHEN size(found) > 0 THEN sort_array(transform(filter(found, (x, k) -> coalesce(get(found, k - 1).h = x.h, false) OR coalesce(get(found, k + 1).h = x.h, false)), x -> x.i)) ELSE array() END")).drop("found")
    covered = f"CASE WHEN size(at) > 0 THEN aggregate(transform(at, (p, k) -> least({WINDOW}, coalesce(p - get(at, k - 1), {WINDOW}))), 0L, (a, x) -> a + x) ELSE 0L END"
    return rows.withColumn("n_repeat_words", F.expr(covered)).drop("at")


def base_rules(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """id, text_hash, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and normalised lines of every text."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("own"))
    lines = F.filter(F.split("own", "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")
    rows = with_lines(rows).withColumns({"w": words(F.col("own")), "raw_lines": lines})
    rows = rows.select(
        "id",
        F.xxhash64("own").alias("text_hash"),
        "host",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("own", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("runs_1"),
        "lines",
    )
    rows = _with_repeats(rows)
    return rows.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def line_hashes(rows: DataFrame) -> DataFrame:
    """Of rows (id, text_hash, host, lines) a row for each line with a word: id, text_hash, host, place, hash of the normalised line, and its number of words."""
    return rows.select("id", "text_hash", "host", F.posexplode("lines").alias("place", "line")).select("id", "text_hash", "host", "place", "line.*").where("line_words > 0")


def frequent_lines(lines: DataFrame, rows: DataFrame, *, most_docs: int = 20, most_share: float = 0.02) -> DataFrame:
    """(host, line_hash, line_docs) of lines above both limits; rows: (id, host) of all documents."""
    hosts = rows.groupBy("host").agg(F.count_distinct("id").alias("host_docs"))
    counts = lines.groupBy("host", "line_hash").agg(F.count_distinct("id").alias("line_docs")).where(F.col("line_docs") > most_docs)
    return counts.join(hosts, "host").where(F.col("line_docs") > most_share * F.col("host_docs")).select("host", "line_hash", "line_docs")


def apply_rules(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source", most_docs: int = 20, most_share: float = 0.02, least_words: int = 20, least_left: float = 0.5) -> DataFrame:
    """base_rules() with n_line_words, the words in frequent lines, and kept."""
    rows = stored(base_rules(docs, doc_id=doc_id, text=text, host=host), "rules")
    lines = line_hashes(rows)
    frequent = frequent_lines(lines, rows, most_docs=most_docs, most_share=most_share)
    removed = lines.join(frequent, ["host", "line_hash"]).groupBy("id", "text_hash", "host", "place").agg(F.max("line_words").alias("line_words"))
    removed = removed.groupBy("id", "text_hash", "host").agg(F.sum("line_words").alias("n_line_words")).groupBy("id", "text_hash").agg(F.max("n_line_words").alias("n_line_words"))
    rows = rows.drop("lines", "host").join(removed, ["id", "text_hash"], "left")
    rows = rows.withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("n_line_words")
    return rows.withColumn("kept", ~F.col("base_failed") & (left >= least_words) & (left >= least_left * F.col("n_words"))).drop("text_hash")


def remove_frequent_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """(id, text) of all documents without their frequent lines; the other lines stay as they are, in order."""
    own = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col(text).alias("text"), F.coalesce(text, F.lit("")).alias("own"))
    texts = with_lines(own).withColumn("text_hash", F.xxhash64("own"))
    rows = stored(texts.select("id", "host", "text_hash", "lines"), "lines")
    lines = line_hashes(rows)
    gone = lines.join(frequent_lines(lines, rows, **limits), ["host", "line_hash"]).groupBy("id", "text_hash").agg(F.collect_set("place").alias("gone"))
    texts = texts.select("id", "text", "own", "text_hash").join(gone, ["id", "text_hash"], "left")
    left = F.expr("array_join(filter(split(own, '\\n'), (x, i) -> NOT array_contains(gone, i)), '\\n')")
    return texts.select("id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"))


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_line_words", "base_failed", "kept"
    )


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, coalesce(source, '') AS host FROM documents),
w AS (SELECT doc_id, x, regexp_extract_all(x, '[^ \t-\r]+') AS w, list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^ \t-\r]')) AS l FROM t),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS g FROM w, unnest(range(1, greatest(len(w) - 6, 1))) AS r(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 8)) AS r(p) GROUP BY doc_id),
lines AS (SELECT doc_id, host, trim(regexp_replace(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'), '[ \t-\r]+', ' ', 'g'), ' ') AS l
          FROM (SELECT doc_id, host, unnest(string_split(x, chr(10))) AS l FROM t)),
hosts AS (SELECT host, count(DISTINCT doc_id) AS n FROM t GROUP BY host),
freq AS (SELECT c.host, l FROM (SELECT host, l, count(DISTINCT doc_id) AS c FROM lines WHERE l <> '' GROUP BY host, l) c JOIN hosts h ON c.host = h.host WHERE c > 20 AND c > 0.02 * n),
gone AS (SELECT doc_id, sum(len(string_split(lines.l, ' '))) AS n FROM lines JOIN freq ON lines.host = freq.host AND lines.l = freq.l GROUP BY doc_id),
a AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(x, '[ \t-\r]+', '', 'g'))::BIGINT AS word_chars,
             (length(x) - length(translate(x, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_line_words
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN gone ON gone.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND n_words - n_line_words >= 20 AND n_words - n_line_words >= 0.5 * n_words AS kept FROM b
"""
