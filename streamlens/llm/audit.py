"""Audit of how filters interact: what each removes in every order they can be applied in.

Every document fails some of five filters; all answers are sums over the documents of a
part that fail the same set, so a part needs 32 counts and no order reads a document again.

Whether a text repeats is settled in two steps.  A counting Bloom sketch of the hashes of
all texts, in pages of a fixed number of cells and merged by Spark's aggregates, clears the
texts that are surely unique: some cell of theirs was counted once.  Only the others are
shuffled, by their full texts, for the least id of each.  The sketch has sixteen cells a
text up to ``MAX_PAGES`` pages (256 MB as bits, which is what is broadcast); in larger
tables cells are shared by more texts, so more texts are shuffled, and results stay exact.

Defined results: a null text is empty; a null source counts as the empty one.  A row without
doc_id is compared with none and repeats none, so it passes E, and it has no label.  Rows of
equal id and equal text are no repeats of each other, but all repeat a smaller id.  A document
is good or toxic if any of its labels says so; null marks say nothing.  An empty table gives
no rows.  Further columns are not read, so their names cannot clash.  Texts are compared whole;
the row that holds the least id of its text is then known by that id and two 64-bit hashes.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm.tables import kept

#: Filters in the order of their letters.
FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
MARKS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"

#: Cells of a page of the sketch, as 1024 words of 64 bits; two cells of one page a text.
PAGE_WORDS = 1024
PAGE_TEXTS = 4096
MAX_PAGES = 1 << 15

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failed_letters(text: Column) -> Column:
    """The letters of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    fails = {
        "A": n < MIN_WORDS,
        "B": F.lit(100) * distinct < F.lit(DISTINCT_PERCENT) * n,
        "C": F.lit(100) * upper > F.lit(UPPER_PERCENT) * F.length(text),
        "D": text.rlike(MARKS),
    }
    return F.concat(*(F.when(test, letter).otherwise("") for letter, test in fails.items()))


def _hashed(documents: DataFrame) -> DataFrame:
    """Rows with ``text`` and its two hashes ``h`` and ``g``."""
    text = F.coalesce("text", F.lit(""))
    found = documents.select("doc_id", "source", text.alias("text"))
    return found.withColumns({"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(1), "text")})


def facts(documents: DataFrame) -> DataFrame:
    """What the audit needs of every document, equal rows counted in ``n``."""
    found = _hashed(documents).select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        failed_letters(F.col("text")).alias("failed"),
        "h",
        "g",
    )
    return found.groupBy("doc_id", "part", "failed", "h", "g").agg(F.count(F.lit(1)).alias("n"))


def _page(n_pages: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), "h"), F.lit(n_pages))


def _cells() -> list[Column]:
    """Two cells of a page, each 0 to 65535, from the bits of ``h``."""
    last = PAGE_WORDS * 64 - 1
    return [F.col("h").bitwiseAND(F.lit(last)), F.shiftright("h", 32).bitwiseAND(F.lit(last))]


def sketch(found: DataFrame, n_pages: int) -> DataFrame:
    """The merged sketch: per ``page`` the cells counted more than once, as bits of ``words``.

    The two cells of a text may be one; then it counts once.  Copies of a text are combined
    before anything is shuffled.
    """
    cells = found.select(_page(n_pages).alias("page"), "n", F.array_distinct(F.array(*_cells())).alias("cells"))
    counted = (
        cells.select("page", "n", F.explode("cells").alias("cell"))
        .groupBy("page", "cell")
        .agg(F.sum("n").alias("n"))
        .filter("n > 1")
    )
    word = F.shiftright("cell", 6).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")
    words = counted.groupBy("page", word).agg(F.bit_or(bit).alias("bits"))
    pages = words.groupBy("page").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("bits")
    )
    every = F.transform(
        F.sequence(F.lit(0), F.lit(PAGE_WORDS - 1)),
        lambda i: F.coalesce(F.try_element_at("bits", i), F.lit(0).cast("long")),
    )
    return pages.select("page", every.alias("words"))


def with_doubt(hashed: DataFrame, pages: DataFrame, n_pages: int) -> DataFrame:
    """Rows with ``doubt``: all their cells were counted more than once, so the text may repeat.

    The sketch goes to the rows; they are not shuffled.
    """
    names = hashed.columns
    met = hashed.withColumn("page", _page(n_pages)).join(F.broadcast(pages), "page", "left")

    def shared(cell: Column) -> Column:
        word = F.get("words", F.shiftright(cell, 6).cast("int"))
        return F.getbit(word, cell.bitwiseAND(F.lit(63)).cast("int")) == 1

    first, second = _cells()
    doubt = F.coalesce(shared(first) & shared(second), F.lit(False))
    return met.select(*names, doubt.alias("doubt"))


def failures(documents: DataFrame) -> DataFrame:
    """The letters every document fails, as ``doc_id, part, failed, n`` (equal rows counted).

    Of the rows in doubt, the least ids of their full texts pass E and the others fail it.
    """
    found = kept(facts(documents), "audit-facts")
    n_pages = max(1, min(MAX_PAGES, -(-found.count() // PAGE_TEXTS)))
    pages = kept(sketch(found, n_pages), "audit-sketch")

    texts = with_doubt(_hashed(documents.filter("doc_id IS NOT NULL")), pages, n_pages)
    least = texts.filter("doubt").groupBy("h", "g", "text").agg(F.min("doc_id").alias("doc_id"))
    firsts = least.select("doc_id", "h", "g", F.lit(True).alias("first"))

    judged = with_doubt(found, pages, n_pages)
    compared = F.col("doubt") & F.col("doc_id").isNotNull()
    in_doubt = judged.filter(compared).join(firsts, ["doc_id", "h", "g"], "left")
    repeats = F.when(F.col("first"), "").otherwise("E")
    settled = in_doubt.withColumn("failed", F.concat("failed", repeats))
    names = ("doc_id", "part", "failed", "n")
    every = settled.select(*names).unionByName(judged.filter(~compared).select(*names))
    return every.groupBy("doc_id", "part", "failed").agg(F.sum("n").alias("n"))


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones per part and set of failed filters.

    Equal rows of an id are one row here, so a hot id is no hot key of the join.
    """
    marks = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    none = F.lit(0).cast("long")
    marked = failed.join(marks.filter("good + toxic > 0"), "doc_id").select(
        "part",
        "failed",
        none.alias("n"),
        (F.col("n") * F.col("good")).alias("good"),
        (F.col("n") * F.col("toxic")).alias("toxic"),
    )
    counted = failed.select("part", "failed", "n", none.alias("good"), none.alias("toxic"))
    return counted.unionByName(marked).groupBy("part", "failed").agg(
        *(F.sum(c).alias(c) for c in ("n", "good", "toxic"))
    )


def orders(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of failed sets."""
    n_orders = len(list(permutations(FILTERS)))
    entries = counts.groupBy("part").agg(
        F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("entries")
    )
    every = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    rows = entries.withColumn("filter_order", F.explode(every)).withColumn("step", F.explode(steps))
    rows = rows.withColumns(
        {
            "filter": F.expr("substr(filter_order, step, 1)"),
            "before": F.expr("substr(filter_order, 1, step - 1)"),
        }
    )

    def total(value, holds) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate(
            "entries", zero, lambda acc, e: acc + F.when(holds(e), value(e)).otherwise(zero)
        )

    def fails(e: Column) -> Column:
        return F.contains(e["failed"], F.col("filter"))

    def gone(e: Column) -> Column:
        left = F.call_function("translate", F.col("before"), e["failed"], F.lit(""))
        return left != F.col("before")

    def one(name: str):
        return lambda e: e[name]

    def share(e: Column) -> Column:
        # Whatever else it fails, each of its filters comes first in as many orders.
        return e["n"] * F.expr(f"{n_orders}L") / F.length(e["failed"])

    return rows.select(
        "part",
        "filter_order",
        "step",
        total(one("n"), lambda e: ~gone(e) & ~fails(e)).alias("kept"),
        total(one("n"), lambda e: fails(e) & ~gone(e)).alias("removed"),
        total(one("n"), lambda e: fails(e) & gone(e)).alias("redundant"),
        total(one("n"), lambda e: e["failed"] == F.col("filter")).alias("unique_fails"),
        total(one("good"), lambda e: fails(e) & ~gone(e)).alias("good_lost"),
        total(one("toxic"), lambda e: fails(e) & ~gone(e)).alias("toxic_lost"),
        total(lambda e: share(e).cast("long"), fails).alias("shapley"),
    )


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``documents`` (doc_id, source, text) with ``labels`` (doc_id, quality, toxic)."""
    failed = kept(failures(documents), "audit-failures")
    return orders(mask_counts(failed, labels))


#: The same by brute force, for DuckDB.
SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
), failed AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS f
  FROM words
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, f, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT o, CAST(s AS INTEGER) AS step, substr(o, s, 1) AS x, substr(o, 1, s - 1) AS before
  FROM orders, range(1, 6) AS r(s)
), judged AS (
  SELECT part, o, step, x, f, n, good, toxic, contains(f, x) AS fails,
         translate(before, f, '') <> before AS gone FROM counts, steps
), found AS (
  SELECT part, o AS filter_order, step, any_value(x) AS x,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
         coalesce(sum(n) FILTER (f = x), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
  FROM judged GROUP BY part, o, step
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM found
"""
