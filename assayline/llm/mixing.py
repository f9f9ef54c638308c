"""Mixing sources to target weights by Pareto order sampling."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayline.llm.common import refuse_clash, stage, text_or_empty, word_count

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = 17
# Slices of the rank order, and slices that are summed together at first.
SLICES, GROUP = 65536, 256


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """Targets of sources from (source, source_size).

    Sources in code point order (null last) weigh ``weights`` in turn and
    share the sum of all sizes. A target stops at ``most`` times its source's
    size and the excess is shared again by weight until none is above: the
    level at which ``sum(min(cap, weight * level))`` is the whole. The level is
    found from running sums over the sources sorted by the level at which
    each is full. Works on one row per source, not on documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.select(
        "source",
        "source_size",
        F.row_number().over(by_name).cast("long").alias("source_no"),
        F.element_at(listed, turn + 1).alias("weight"),
        (F.col("source_size") * most).cast("double").alias("cap"),
    )
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    level = (
        F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    found = named.withColumn("level", level).withColumn(
        "fits", F.col("level") <= F.col("cap") / F.col("weight")
    )
    final = F.max(F.when(F.col("fits"), F.col("level"))).over(whole)
    return found.withColumn("final", final).select(
        "source",
        "source_no",
        "source_size",
        F.least("cap", F.col("weight") * F.col("final")).alias("target"),
    )


def _first_reaching(sums: DataFrame, place: str) -> DataFrame:
    """Per source the first place at which ``__start`` and the running sum of
    ``__words`` reach ``__need``, and the sum before it."""
    running = Window.partitionBy("source_no").orderBy(place)
    upto = sums.withColumn("__upto", F.col("__start") + F.sum("__words").over(running))
    before = (F.col("__upto") - F.col("__words")).alias("__before")
    return (
        upto.filter(F.col("__upto") >= F.col("__need"))
        .groupBy("source_no")
        .agg(F.min(F.struct(place, before)).alias("__cut"))
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = SEED,
    keep_columns: tuple[str, ...] = (),
) -> DataFrame:
    """How many whole copies of each document a mix by source takes.

    Every document of a source is taken ``floor(target / source_size)`` times
    for certain. The words that remain are a sample: documents are ranked by
    their random odds u/(1-u) over their inclusion odds p/(1-p) and taken in
    that order until the words are nearest the target. Inclusion falls with
    the root of a document's size against its source's mean, between half and
    twice the source's fraction. u comes from the MD5 of seed and id, so
    reruns agree.

    The cut in the order is found without sorting a source: the order is cut
    into slices whose words are summed, the running sum names the slice in
    which the target lies, and only the rows of that slice are ranked. A hot
    source moves as at most ``SLICES`` sums a task.

    Null text has size 0 and takes nothing; null is a source of its own;
    equal ranks are settled by id and size; repeated rows are sampled like
    other rows, and rows equal in all of this are interchangeable. An empty
    table gives no rows.

    Columns: id, source, size, source_size, target, copies, taken, and
    ``keep_columns``; the names of the result's own columns are refused there.
    """
    made = (id_col, "source", "size", "source_size", "target", "copies", "taken")
    refuse_clash(keep_columns, made)
    kept = [F.col(c).alias(f"__keep_{c}") for c in keep_columns]
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    sized = stage(
        docs.select(
            F.col(id_col).alias("__id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(text_or_empty(text_col)).alias("size"),
            (
                (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") + 0.5)
                / float(2**52)
            ).alias("__u"),
            *kept,
        ),
        "mix-sizes",
    )
    sizes = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("__rows")
    )
    targets = source_targets(sizes.drop("__rows"), weights, most)
    # One row per source; its size on disk decides how it is joined below.
    plan = stage(
        targets.join(
            sizes.select(F.col("source").alias("__source"), "__rows"),
            F.col("source").eqNullSafe(F.col("__source")),
        ).select(
            F.col("source").alias("__source"),
            "source_no",
            "source_size",
            "target",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(0)
            .cast("long")
            .alias("__whole"),
            (F.col("source_size") / F.col("__rows")).alias("__mean"),
        ),
        "mix-sources",
    )
    need = F.col("target") - F.col("__whole") * F.col("source_size")
    tilt = F.least(
        F.lit(2.0), F.greatest(F.lit(0.5), F.sqrt(F.col("__mean") / F.col("size")))
    )
    p = F.least(
        F.lit(0.999999), F.greatest(F.lit(1e-9), need / F.col("source_size") * tilt)
    )
    ranked = (
        sized.join(plan, F.col("source").eqNullSafe(F.col("__source")))
        .drop("__source")
        .withColumn("__need", need)
        .withColumn("__p", F.when(F.col("size") > 0, p))
        .withColumn(
            "__q",
            (F.col("__u") / (1 - F.col("__u"))) / (F.col("__p") / (1 - F.col("__p"))),
        )
        .withColumn(
            "__slice", F.floor(F.col("__q") / (1 + F.col("__q")) * SLICES).cast("long")
        )
    )
    sums = ranked.filter("size > 0").groupBy("source_no", "__slice").agg(
        F.sum("size").alias("__words"), F.first("__need").alias("__need")
    )
    # The group of slices, then the slice: each looks at some hundred sums.
    grouped = sums.withColumn("__group", F.floor(F.col("__slice") / GROUP))
    totals = grouped.groupBy("source_no", "__group").agg(
        F.sum("__words").alias("__words"), F.first("__need").alias("__need")
    )
    rough = _first_reaching(totals.withColumn("__start", F.lit(0).cast("long")), "__group")
    narrowed = grouped.join(
        rough.select(
            F.col("source_no").alias("__no"),
            F.col("__cut.__group").alias("__at"),
            F.col("__cut.__before").alias("__start"),
        ),
        (F.col("source_no") == F.col("__no")) & (F.col("__group") == F.col("__at")),
    )
    fine = _first_reaching(narrowed, "__slice")
    cuts = stage(fine.select(F.col("source_no").alias("__no"), "__cut"), "mix-cuts")
    placed = ranked.join(cuts, F.col("source_no") == F.col("__no"), "left").drop("__no")
    # Without a cut the whole source is needed; sizes of 0 take nothing anyway.
    inside = (F.col("size") > 0) & (F.col("__slice") == F.col("__cut.__slice"))
    inside = F.coalesce(inside, F.lit(False))
    clear = placed.filter(~inside).withColumn(
        "__more",
        (F.col("size") > 0)
        & (F.col("__need") > 0)
        & F.coalesce(F.col("__slice") < F.col("__cut.__slice"), F.lit(True)),
    )
    order = Window.partitionBy("source_no").orderBy(
        "__q", F.col("__id").asc_nulls_last(), "size"
    ).rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("__cut.__before") + F.sum("size").over(order) - F.col("size") / 2
    near = placed.filter(inside).withColumn("__more", middle <= F.col("__need"))
    copies = F.col("__whole") + F.col("__more").cast("long")
    return (
        clear.unionByName(near)
        .withColumn("copies", copies)
        .select(
            F.col("__id").alias(id_col),
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            *[F.col(f"__keep_{c}").alias(c) for c in keep_columns],
        )
    )
