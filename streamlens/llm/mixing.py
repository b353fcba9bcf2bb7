"""Mix sources to target weights by a low-discrepancy schedule; DataFrame operations only.

Targets.  Sources in code point order (null last) weigh 5, 2, 1, repeating, and
share the words of all documents; a target stops at ``MOST_EPOCHS`` times its
source's size and the excess goes to the others by weight.  That is a water level:
with sources in ascending order of size / weight, those whose limit lies below
the level get their limit, the others weight * level.

Schedule.  Slot i of the mix takes the source in whose part of [0, 1) the van der
Corput point of i falls; parts are as wide as targets.  The rank of a slot among
those of its source has a closed form (how many of the first i points lie below a
bound), so no slots are brought together.  Slot number j of a source takes block j
of that source's endless repetition of its shuffled documents; blocks hold equally
many words.

Sizes are words; the shuffle follows md5(seed, doc_id).

Defined results: a null or empty text has size 0 and nothing is taken of it; a null
source is a source; rows that repeat a doc_id are mixed one by one (equal rows are
interchangeable); without any word all targets are 0; extra columns stay in
``mix`` and are ignored in ``report``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlens.llm.tables import kept

# Weights in turn, and how often a source may be repeated.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
# Words of a block, and slots below which blocks get smaller.
BLOCK_WORDS = 4096
LEAST_SLOTS = 1 << 20
POINT_BITS = 40
GROUP_DOCS = 4096
SEED = "mix-1"

_SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    whole = F.coalesce(F.col(text), F.lit(""))
    first, last = F.substring(whole, 1, 1), F.substring(whole, -1, 1)
    outside = ((first == "") | first.rlike(_SPACE)).cast("int") + last.rlike(_SPACE).cast("int")
    return (F.size(F.split(whole, _SPACE)) - outside).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: source, size, documents, number, weight, target, total.

    One row per source is few enough for windows over all of them.
    """
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    every = Window.partitionBy(F.lit(1))
    rank = F.row_number().over(every.orderBy(F.asc_nulls_last(F.encode("source", "UTF-8"))))
    weight = F.element_at(
        F.array(*(F.lit(w).cast("long") for w in WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int")
    )
    limit = MOST_EPOCHS * F.col("source_size")
    by_level = every.orderBy(F.col("limit") / F.col("weight"), "number")
    upto, onward = (
        by_level.rowsBetween(Window.unboundedPreceding, -1),
        by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing),
    )
    ranked = (
        sums.withColumn("number", (rank - 1).cast("long"))
        .withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("spent", F.coalesce(F.sum("limit").over(upto), F.lit(0).cast("long")))
        .withColumn("shares", F.sum("weight").over(onward))
    )
    # The level if this source were the first that is not held at its limit.
    level = (F.col("total") - F.col("spent")) / F.col("shares").cast("double")
    held = F.col("limit") < F.col("weight") * level
    leveled = ranked.withColumn("level", level).withColumn("held", held)
    level_all = F.min(F.when(~F.col("held"), F.struct("spent", "level"))).over(every)["level"]
    return leveled.withColumn(
        "target",
        F.when(F.col("held"), F.col("limit").cast("double")).otherwise(
            F.least(F.col("weight") * level_all, F.col("limit").cast("double"))
        ),
    ).select("source", "source_size", "docs", "number", "weight", "target", "total")


def parts(sources: DataFrame) -> DataFrame:
    """Sources with their part [low, high) of the points, in units of 2^-POINT_BITS."""
    upto = Window.partitionBy(F.lit(1)).orderBy("number")
    scale = float(1 << POINT_BITS)
    share = F.sum("target").over(upto) / F.sum("target").over(Window.partitionBy(F.lit(1)))
    high = F.when(F.col("total") > 0, F.round(share * scale).cast("long")).otherwise(F.lit(0).cast("long"))
    bounded = sources.withColumn("high", high)
    return bounded.withColumn("low", F.coalesce(F.lag("high").over(upto), F.lit(0).cast("long")))


def _points_below(bound: str) -> str:
    """How many of the first ``slot`` van der Corput points lie below ``bound``.

    The first ``slot`` numbers are one aligned run for each bit set in ``slot``.
    The points of a run of 2^k numbers are 2^-k apart, and the first of them is
    what the lower digits of ``point`` say.
    """
    one = "cast(1 AS bigint)"
    step = f"shiftleft({one}, {POINT_BITS} - k)"
    first = f"(point & (shiftleft({one}, {POINT_BITS - 1} - k) - 1))"
    run = f"least(greatest(({bound} - {first} + {step} - 1) div {step}, cast(0 AS bigint)), shiftleft({one}, k))"
    return f"""aggregate(sequence(0, length(bin(slot)) - 1), cast(0 AS bigint), (n, k) ->
        n + CASE WHEN (slot & shiftleft({one}, k)) <> 0 THEN {run} ELSE cast(0 AS bigint) END)"""


def schedule(sources: DataFrame) -> DataFrame:
    """Every slot of the mix: slot, source number, rank among the source's slots.

    Points are compared with the parts of the sources by one lookup in an array
    with an entry per source.
    """
    spark = sources.sparkSession
    bounds = parts(sources).agg(
        F.max("total").alias("total"),
        F.array_sort(F.collect_list(F.struct("low", "high", "number"))).alias("parts"),
    )
    block = block_words("total")
    sized = bounds.withColumn("slots", F.ceil(F.col("total") / block).cast("long"))
    # Slots are numbered in runs of 2^12, so that the list of runs stays short.
    runs = sized.filter("slots > 0").select(
        "parts", "slots", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("slots") - 1) / 4096).cast("long"))).alias("run")
    )
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = runs.repartition(width, "run").select(
        "parts", "slots", F.explode(F.expr("sequence(run * 4096, least(run * 4096 + 4095, slots - 1))")).alias("slot")
    )
    # One-row generators keep Catalyst from repeating a column for every use of it.
    point = F.expr(f"cast(conv(reverse(lpad(bin(slot), {POINT_BITS}, '0')), 2, 10) AS bigint)")
    part = F.expr("filter(parts, p -> p.low <= point AND point < p.high)[0]")
    placed = (
        slots.withColumn("point", F.explode(F.array(point)))
        .withColumn("part", F.explode(F.array(part)))
        .select("slot", "point", "part.low", "part.high", "part.number")
    )
    rank = F.expr(f"({_points_below('high')}) - ({_points_below('low')})")
    return placed.select("slot", "number", rank.alias("rank"))


def block_words(total: str) -> Column:
    return F.least(F.greatest(F.floor(F.col(total) / LEAST_SLOTS), F.lit(1)), F.lit(BLOCK_WORDS)).cast("long")


def positions(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with ``begin``: words of their source before them in its shuffled order.

    A source's documents are dealt into groups of about ``GROUP_DOCS`` by hash;
    sums run within groups and over the groups of a source, so no task gets a
    whole source.
    """
    few = F.broadcast(sources) if sources_are_few(sources) else sources
    joined = sized.join(few, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    order = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    groups = F.greatest(F.ceil(F.col("docs") / GROUP_DOCS), F.lit(1)).cast("long")
    hashed = joined.withColumn("place", order).withColumn(
        "group", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / float(1 << 32) * groups).cast("long")
    )
    within = (
        Window.partitionBy("number", "group")
        .orderBy("place", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = Window.partitionBy("number").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = hashed.groupBy("number", "group").agg(F.sum("size").alias("words"))
    sums = sums.select(
        "number", "group", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")).alias("ahead")
    )
    inside = hashed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0).cast("long")))
    return inside.join(sums, ["number", "group"]).withColumn("begin", F.col("ahead") + F.col("inside"))


FEW_SOURCES = 10_000


def sources_are_few(sources: DataFrame) -> bool:
    return sources.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES


def mix(documents: DataFrame) -> DataFrame:
    """``documents`` with size, source_size, target and taken (words, repeats counted)."""
    rows = kept(
        documents.select("*", word_count("text").alias("size"), F.expr("uuid()").alias("__row")),
        "mix-sized",
    )
    taken = _taken(rows.select("__row", "doc_id", "source", "size"))
    return rows.join(taken.drop("doc_id", "source", "size"), "__row").drop("__row")


def repeat(documents: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, to the nearest whole."""
    times = F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    mixed = mix(documents).withColumn("__times", times).filter("__times > 0")
    again = mixed.withColumn("__time", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return again.select(*documents.columns)


def _taken(sized: DataFrame) -> DataFrame:
    """``sized`` (with a row name ``__row``) with source_size, target and taken."""
    sources = kept(targets(sized), "mix-sources")
    placed = kept(positions(sized, sources), "mix-positions")
    block = block_words("total")
    # Blocks that a document's words fall into, in each repetition of its source.
    epochs = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(MOST_EPOCHS - 1).cast("long")))
    begin = F.col("begin") + F.col("epoch") * F.col("source_size")
    # No block beyond the source's part of the slots, with room for the rounding, is asked for.
    last = F.ceil(F.col("target") / F.col("block")).cast("long") + 2 * POINT_BITS
    spans = (
        placed.filter("size > 0")
        .withColumn("block", block)
        .withColumn("epoch", epochs)
        .select("__row", "number", "size", "block", last.alias("last"), begin.alias("begin"))
        .withColumn("first_block", F.expr("begin div block"))
        .withColumn("last_block", F.least(F.expr("(begin + size - 1) div block"), F.col("last")))
        .filter("first_block <= last_block")
    )
    pieces = spans.withColumn("rank", F.explode(F.sequence("first_block", "last_block"))).select(
        "__row",
        "number",
        "rank",
        F.expr("least(begin + size, (rank + 1) * block) - greatest(begin, rank * block)").alias("words"),
    )
    # Spark takes the schedule for one row per run; it grows with the input.
    took = (
        pieces.join(schedule(sources).hint("merge"), ["number", "rank"])
        .groupBy("__row")
        .agg(F.sum("words").alias("taken"))
    )
    return placed.join(took, "__row", "left").select(
        "__row", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )


def report(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    sized = kept(
        documents.select("doc_id", "source", word_count("text").alias("size"), F.expr("uuid()").alias("__row")),
        "mix-sized",
    )
    return _taken(sized).drop("__row", "source")


def oracle_sql() -> str:
    """The report as SQL, from the closed form of what the schedule takes."""
    bits = POINT_BITS
    return f"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS number
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE number % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most,
         CAST(sum(source_size) OVER () AS BIGINT) AS total
  FROM sums
), ranked AS (
  SELECT *,
    coalesce(sum(most) OVER (ORDER BY CAST(most AS DOUBLE) / weight, number
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
    sum(weight) OVER (ORDER BY CAST(most AS DOUBLE) / weight, number
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares
  FROM weighed
), leveled AS (
  SELECT *, CAST(total - spent AS DOUBLE) / CAST(shares AS DOUBLE) AS level,
         most < weight * (CAST(total - spent AS DOUBLE) / CAST(shares AS DOUBLE)) AS held
  FROM ranked
), aimed AS (
  SELECT *, CASE WHEN held THEN CAST(most AS DOUBLE)
    ELSE least(weight * (SELECT arg_min(level, spent) FROM leveled WHERE NOT held), CAST(most AS DOUBLE))
    END AS target
  FROM leveled
), bounded AS (
  SELECT *, CASE WHEN total > 0 THEN CAST(round(sum(target) OVER (ORDER BY number) / sum(target) OVER ()
                 * {1 << bits}) AS BIGINT) ELSE 0 END AS high,
    least(greatest(total // {LEAST_SLOTS}, 1), {BLOCK_WORDS}) AS block
  FROM aimed
), parts AS (
  SELECT *, coalesce(lag(high) OVER (ORDER BY number), 0) AS low FROM bounded
), points AS (
  SELECT list_sum([((slot >> b) & 1) << ({bits - 1} - b) FOR b IN range({bits})]) AS point
  FROM (SELECT unnest(range(CAST(ceil(total / block) AS BIGINT))) AS slot
        FROM (SELECT DISTINCT total, block FROM parts))
), taken AS (
  SELECT p.source, p.source_size, p.target,
         least(count(point) * p.block, 3 * p.source_size) AS words
  FROM parts p LEFT JOIN points ON point >= p.low AND point < p.high
  GROUP BY p.source, p.source_size, p.target, p.block
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.words,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY place, s.size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN taken t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CASE WHEN size = 0 THEN CAST(0 AS BIGINT) ELSE CAST(words // source_size * size
         + least(greatest(words % source_size - ahead, 0), size) AS BIGINT) END AS taken
FROM placed
"""
