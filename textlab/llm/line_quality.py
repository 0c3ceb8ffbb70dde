"""Quality rules with the frequency of lines across the documents of a host, in built-in functions only.

A line is normalised (lower case, digits to 0, white space runs to one blank, ends trimmed) and hashed. Per host the
distinct documents that hold a line are counted, a document being its text: exact copies count once. A line
is above the limit if it is in more than `least_documents` of them and in more than `share` of all documents of
the host. The words of such lines are removed; a document that keeps less than `least_left` of its words is
depleted and rejected.

A null host is a host of its own. Null texts have no words and fail. Rows given twice get equal results. Lines without a
word are not counted. Counting combines before each shuffle and carries hashes, no texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textlab.session import stage

SPACE = r"[\x20\x09-\x0D]"
_BLANKS = " \t\n\x0b\x0c\r"
_PLACE_BITS = 24  # of a number that holds the upper bits of a hash, too


def words_of(text: Column) -> Column:
    """Runs without ASCII white space."""
    inner = F.btrim(text, F.lit(_BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE + "+"))


def with_repeated_words(rows: DataFrame, words: str, out: str, width: int = 3) -> DataFrame:
    """Add the number of words inside windows of `width` words that come twice or more, the first time included.

    Windows are hashed; a text whose windows all differ is done. In the others, the upper bits of a hash and its place are one number; these are
    sorted, and those next to the same hash are repeated. Should two different hashes share their upper bits, or a place need
    more bits, the text goes the long way, by pairs of whole hashes and places. A place covers `width` words, less what the
    next place covers. Each step is a column, so that no lambda computes an array anew.
    """
    low = F.lit((1 << _PLACE_BITS) - 1)
    last = F.size(words) - width
    window = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)])
    rows = rows.withColumn("_hashes", F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window)))
    again = F.size("_hashes") > F.size(F.array_distinct("_hashes"))
    number = lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("bigint"))
    rows = rows.withColumn("_numbers", F.when(again, F.sort_array(F.transform("_hashes", number))))
    alike = lambda x, y: F.shiftrightunsigned(x.bitwiseXOR(y), _PLACE_BITS) == 0
    near = lambda x, j: F.coalesce(alike(x, F.get("_numbers", j - 1)), F.lit(False)) | F.coalesce(alike(x, F.get("_numbers", j + 1)), F.lit(False))
    rows = rows.withColumn("_near", F.filter("_numbers", near))
    whole = lambda x: F.get("_hashes", x.bitwiseAND(low).cast("int"))
    differs = lambda x, j: (j > 0) & alike(x, F.get("_near", j - 1)) & (whole(x) != whole(F.get("_near", j - 1)))
    long_way = (F.size("_hashes") > 1 << _PLACE_BITS) | (F.size(F.filter("_near", differs)) > 0)
    rows = rows.withColumn("_pairs", F.when(long_way, F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    beside = lambda x, j: (F.get("_pairs", j - 1)["h"] == x["h"]) | (F.get("_pairs", j + 1)["h"] == x["h"])
    by_pairs = F.transform(F.filter("_pairs", beside), lambda x: x["i"])
    by_numbers = F.transform("_near", lambda x: x.bitwiseAND(low).cast("int"))
    rows = rows.withColumn("_places", F.sort_array(F.when(F.col("_pairs").isNotNull(), by_pairs).otherwise(by_numbers)))
    step = lambda p, i: F.coalesce(F.least(F.lit(width), F.get("_places", i + 1) - p), F.lit(width))
    total = F.aggregate(F.transform("_places", step), F.lit(0), lambda total, x: total + x)
    counted = rows.withColumn(out, F.when(F.size("_places") > 0, total).otherwise(0).cast("bigint"))
    return counted.drop("_hashes", "_numbers", "_near", "_pairs", "_places")


def statistics(documents: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Base statistics of each whole text, with its host and a hash and size that stand for the text."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{host}`").alias("host"), content.alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("lines", lines_of(F.col("text")))
    rows = rows.select(
        "key",
        "host",
        F.xxhash64("text").alias("content"),
        F.octet_length("text").alias("size"),
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
    )
    return with_repeated_words(rows, "words", "n_repeat_words").drop("words")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), SPACE + "+", " "))


def line_table(documents: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """`(host, content, size, place, line, n)`: lines of each distinct text of a host, and a row at place 0 for the text."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = documents.select(F.col(f"`{host}`").alias("host"), content.alias("text"))
    row = lambda line: F.struct(F.xxhash64(normal_line(line)).alias("line"), F.size(words_of(line)).cast("bigint").alias("n"))
    head = F.array(F.struct(F.lit(None).cast("bigint").alias("line"), F.lit(0).cast("bigint").alias("n")))
    lines = F.concat(head, F.transform(lines_of(F.col("text")), row))
    exploded = rows.select("host", F.xxhash64("text").alias("content"), F.octet_length("text").alias("size"), F.posexplode(lines).alias("place", "x"))
    return exploded.select("host", "content", "size", "place", "x.line", "x.n").distinct()


def removed_words(lines: DataFrame, least_documents: int = 10, share: float = 0.05) -> DataFrame:
    """`(host, content, size, removed)` of the texts that hold a line above the limit of its host."""
    documents = lines.filter("place = 0").groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    held = lines.filter("line IS NOT NULL").select("host", "line", "content", "size").distinct()
    counts = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("found")).filter(F.col("found") > least_documents)
    frequent = counts.join(documents, counts["host"].eqNullSafe(documents["host"])).filter(F.col("found") > F.col("documents") * share)
    frequent = frequent.select(counts["host"].alias("of_host"), F.col("line").alias("of_line"))
    above = lines.join(frequent, [lines["host"].eqNullSafe(frequent["of_host"]), lines["line"] == frequent["of_line"]], "left_semi")
    return above.groupBy("host", "content", "size").agg(F.sum("n").alias("removed"))


def judged(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    least_documents: int = 10,
    share: float = 0.05,
    least_left: float = 0.5,
) -> DataFrame:
    """`(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed_words)`."""
    stats = statistics(documents, key, text, host)
    removed = removed_words(stage(line_table(documents, text, host), "lines"), least_documents, share)
    same = [stats["host"].eqNullSafe(removed["host"]), stats["content"] == removed["content"], stats["size"] == removed["size"]]
    both = stats.join(removed, same, "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return both.select(
        stats["key"].alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (left >= F.col("n_words") * least_left)).alias("kept"),
        F.coalesce("removed", F.lit(0)).cast("bigint").alias("n_removed_words"),
    )
