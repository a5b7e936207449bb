"""Mixing sources to target weights by systematic sampling."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from areastats.llm.common import fresh, numbered, stored

WORDS = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order of their names, repeating.
WEIGHTS = (3, 1, 2)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), repeats: int = 2) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    The targets share share[0]/share[1] of all sizes by weight. A target stops at `repeats` times
    its source's size and its excess is shared anew until none is above: with sources in
    order of size/weight those that stop are a prefix, so running sums settle it.
    One small row per source is sorted in one task; sums are whole numbers, so the order does
    not show.
    """
    scale = 1
    for w in weights:
        scale *= w
    listed = F.array(*[F.lit(w) for w in weights])
    named = sizes.withColumn("turn", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    named = named.withColumn("weight", F.element_at(listed, (F.pmod(F.col("turn") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = W.orderBy((F.col("source_size") * (F.lit(scale) / F.col("weight"))).cast("long"), F.col("turn")).rowsBetween(W.unboundedPreceding, -1)
    run = named.select(
        "source", "source_size", "weight",
        F.sum("source_size").over(everything).alias("all_size"),
        F.coalesce(F.sum("source_size").over(order), F.lit(0)).alias("size_before"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0))).alias("weight_left"),
    )
    top, bottom = share
    left = F.lit(top) * F.col("all_size") - F.lit(repeats * bottom) * F.col("size_before")
    run = run.withColumn("stops", left * F.col("weight") >= F.lit(repeats * bottom) * F.col("source_size") * F.col("weight_left"))
    run = run.select(
        "source", "source_size", "weight", "stops",
        (F.lit(top) * F.col("all_size") - F.lit(repeats * bottom) * F.sum(F.when(F.col("stops"), F.col("source_size")).otherwise(0)).over(everything)).alias("rest"),
        F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything).alias("rest_weight"),
    )
    open_target = (F.col("weight") * F.col("rest")).cast("double") / (F.lit(bottom) * F.col("rest_weight")).cast("double")
    return run.select(
        "source", "source_size",
        F.when(F.col("stops"), (F.lit(repeats) * F.col("source_size")).cast("double")).otherwise(open_target).alias("target"),
    )


def offset(source: Column, seed: int) -> Column:
    """One number in [0, 1) for each source; the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), repeats: int = 2, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every document.

    With `row_col`, a long that is unique, that column comes too, as `row`, and orders rows of equal id and size.

    In the order of size and id within its source, every document adds its expected copies
    (target / source_size) to a running sum that starts at a random offset, and comes once for
    each whole number the sum passes. Neighbours in this order are of like size, so the words
    taken stay within a document's size of the target. Null texts have size 0; a null source
    is a source, a null id comes first; rows with equal id and size share their copies in any order. The running sum
    is the rank times the expected copies: ranks come from one range partitioning of small rows
    and counts per partition, so a source may hold any share of the rows. An empty table gives no rows.
    """
    counted = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
            F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("long").alias("size"),
            (F.lit(None).cast("long") if row_col is None else F.col(row_col)).alias("row"),
        ),
        "sizes",
    )
    keys = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id"), *([] if row_col is None else [F.col("row")])]
    placed = counted.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("part", F.shiftright("place", 33)), "places")
    parts = stored(placed.groupBy("part", "source").agg(F.min("place").alias("first"), F.count("*").alias("rows"), F.sum("size").alias("words")), "parts")
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts_before = parts.select("part", "source", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    goals = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, repeats)
    goals = goals.select(F.col("source").alias("goal_source"), "source_size", "target")
    known = parts_before.join(goals, F.col("source").eqNullSafe(F.col("goal_source"))).select(
        F.col("part").alias("known_part"), F.col("source").alias("known_source"), "shift", "source_size", "target"
    )
    ranked = placed.join(known, (F.col("part") == F.col("known_part")) & F.col("source").eqNullSafe(F.col("known_source")))
    rank = F.col("place") + F.col("shift")
    passed = lambda r: F.floor(r * F.col("target") / F.col("source_size") + offset(F.col("source"), seed))
    copies = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.least(F.lit(repeats), passed(rank) - passed(rank - 1)))
    shown = ["doc_id", "source", "size", "source_size", "target", *([] if row_col is None else ["row"])]
    return ranked.select(*shown, copies.cast("long").alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


#: The result of `mix` with its defaults.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), named AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][(turn - 1) % 3 + 1]::BIGINT AS weight FROM named
), run AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS all_size,
    coalesce(sum(source_size) OVER before, 0)::BIGINT AS size_before,
    (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS weight_left
  FROM weighed WINDOW before AS (ORDER BY source_size * (6 // weight), turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stopped AS (
  SELECT *, (3 * all_size - 4 * size_before) * weight >= 4 * source_size * weight_left AS stops FROM run
), goals AS (
  SELECT source, source_size, CASE WHEN stops THEN (2 * source_size)::DOUBLE ELSE
    (weight * (3 * all_size - 4 * sum(CASE WHEN stops THEN source_size ELSE 0 END) OVER ()))::DOUBLE
    / (2 * sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM stopped
), ranked AS (
  SELECT s.doc_id, s.source, s.size, g.source_size, g.target,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) AS rank,
    ('0x' || substr(md5('7:' || coalesce(s.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), passed AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(2,
    floor(rank::DOUBLE * target / source_size::DOUBLE + u) - floor((rank - 1)::DOUBLE * target / source_size::DOUBLE + u)) END::BIGINT AS copies
  FROM ranked
)
"""


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row as often as the mix takes it, with all its columns.

    Further columns: `mix_copy` (1, 2, ...), and the mix's size, source_size, target and taken as
    `mix_...`; a column of the documents with such a name gives way to `..._`. Every row has copies of its
    own, those with repeated or null ids too. An empty table gives no rows.
    """
    rows, number = numbered(docs, "documents")
    found = mix(rows, row_col=number, **options).where("copies > 0")
    names = {c: fresh(docs, "mix_" + c) for c in ("copy", "size", "source_size", "target", "taken")}
    shown = found.select(
        F.col("row").alias("mixed_row"), F.sequence(F.lit(1), F.col("copies").cast("int")).alias("mixed_copies"),
        *[F.col(c).alias(f"mixed_{c}") for c in names if c != "copy"],
    )
    shown = stored(shown, "mix")
    # One shuffle of the texts, by row, at any size: the rows are too many to broadcast.
    taken = rows.join(shown.hint("merge"), rows[number] == shown["mixed_row"])
    return taken.select(
        *[rows[f"`{c}`"] for c in docs.columns], F.explode(shown["mixed_copies"]).alias(names["copy"]),
        *[shown[f"mixed_{c}"].alias(n) for c, n in names.items() if c != "copy"],
    )
