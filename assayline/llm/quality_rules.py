"""Quality rules: counts per text and divergence from language references."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import WHITE, WORD, stage, text_or_empty

# Common words of the languages that are told apart.
COMMON = (
    "the", "of", "and", "to", "in", "is", "that", "for", "was", "with",
    "der", "die", "und", "den", "von", "das", "ist", "ein", "nicht", "zu",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "pour",
    "el", "y", "en", "los", "del", "por",
)
# Character classes; what fits none of them is the last class, small letters
# above all.
CLASSES = (
    ("upper", r"[A-Z]"),
    ("digit", r"[0-9]"),
    ("beyond_ascii", r"[^\x00-\x7F]"),
    ("white", WHITE),
    ("symbol", r"[#*$%&|<>]"),
    ("punctuation", r"[!\"'()+,\-./:;=?@\[\\\]\^_`{}~]"),
)
# Documents below this many words are not held against a reference.
LEAST_WORDS = 80
# Distances above these are rejected. Distances of documents labelled good
# stay below them; see the README for the figures.
MOST_CLASSES = 0.27
MOST_WORDS = 0.36
LN2 = 0.6931471805599453


def _repeat_words(words: Column) -> list[tuple[str, Column]]:
    """Steps that end in ``__repeat``: the words covered by 3-word windows
    that occur twice or more. Windows are sorted by hash next to their
    position, so equal ones are neighbours; covered positions are then summed
    in order. All of it is per row, without a shuffle."""
    e = F.col
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            F.xxhash64(
                F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)
            ).alias("h"),
            i.alias("i"),
        ),
    )
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = e("__windows")
    twice = F.filter(
        ordered,
        lambda x, i: (x["h"] == F.get(ordered, i - 1)["h"])
        | (x["h"] == F.get(ordered, i + 1)["h"]),
    )
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum"))
    covered = F.aggregate(
        e("__places"),
        start,
        lambda acc, x: F.struct(
            x.alias("last"),
            (acc["sum"] + F.least(F.lit(3), x - acc["last"])).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return [
        (
            "__windows",
            F.when(F.size(words) >= 3, F.sort_array(windows)).otherwise(empty),
        ),
        ("__twice", twice),
        ("__places", F.sort_array(F.transform(e("__twice"), lambda x: x["i"]))),
        ("__repeat", covered),
    ]


def text_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    the two histograms as arrays of counts. ``text`` must not be null."""
    t = F.col(text)
    bare = F.regexp_replace(t, f"^{WHITE}+|{WHITE}+$", "")
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, WHITE + "+")
    )
    counts = [F.regexp_count(t, F.lit(pattern)).cast("long") for _, pattern in CLASSES]
    out = df.withColumn("__words", words).withColumn("__classes", F.array(*counts))
    for name, step in _repeat_words(F.col("__words")):
        out = out.withColumn(name, step)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    spaced = F.concat(
        F.lit("  "), F.regexp_replace(F.lower(t), r"[^\p{L}]+", "  "), F.lit("  ")
    )
    out = out.withColumn("__lines", lines).withColumn("__spaced", spaced)
    size = F.octet_length("__spaced")
    common = [
        (
            (size - F.octet_length(F.replace(F.col("__spaced"), F.lit(f" {w} "), F.lit(""))))
            / (len(w.encode()) + 2)
        ).cast("long")
        for w in COMMON
    ]
    white = F.element_at("__classes", 4)
    symbols = F.element_at("__classes", 5)
    return out.select(
        *df.columns,
        F.size("__words").cast("long").alias("n_words"),
        (F.length(t) - white).alias("word_chars"),
        symbols.alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias(
            "n_dup_lines"
        ),
        F.col("__repeat").alias("n_repeat_words"),
        F.length(t).cast("long").alias("__chars"),
        "__classes",
        F.array(*common).alias("__common"),
    )


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.ln(x / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(
        p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2)
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(F.lit(0.0), total / (2 * LN2)))


def _shares(counts: Column, whole: Column) -> Column:
    """Shares of the counts and of the rest; all zero for an empty whole."""
    rest = whole - F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    listed = F.concat(counts, F.array(F.greatest(F.lit(0).cast("long"), rest)))
    return F.transform(listed, lambda x: F.when(whole > 0, x / whole).otherwise(F.lit(0.0)))


def _sums(column: str, n: int) -> list[Column]:
    return [F.sum(F.element_at(column, i + 1)) for i in range(n)]


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least_words: int = LEAST_WORDS,
    most_classes: float = MOST_CLASSES,
    most_words: float = MOST_WORDS,
) -> DataFrame:
    """Base counts and verdict of each document, and its Jensen-Shannon
    distance from the references of its language.

    A reference is the pooled histogram of all documents of the language that
    pass the base rules and are long enough: one of character classes, one of
    common words. A language without such documents (and null) is held
    against the pool of all languages; without any, only the base rules
    decide. Documents under ``least_words`` words are not held against a
    reference, as short histograms diverge by chance.

    Counting is per row without a shuffle; the references are one grouping
    with sums combined in the map tasks, so a hot language moves as one row a
    task. Null and empty texts have zero counts and fail the base rules.
    Repeated rows are judged one by one; an empty table gives no rows.

    Columns: id, lang, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, class_distance, word_distance, kept.
    """
    text = docs.select(
        F.col(id_col).alias("__id"),
        F.col(lang_col).cast("string").alias("__lang"),
        text_or_empty(text_col).alias("__text"),
    )
    counted = text_counts(text, "__text").drop("__text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stage(counted.withColumn("base_failed", failed), "quality-counts")
    n, m = len(CLASSES), len(COMMON)
    sound = rows.filter(~F.col("base_failed") & (F.col("n_words") >= least_words))

    def pooled(df: DataFrame, *key: str) -> DataFrame:
        sums = df.groupBy(*key).agg(
            F.array(*_sums("__classes", n)).alias("__cs"),
            F.array(*_sums("__common", m)).alias("__ws"),
            F.sum("__chars").alias("__c"),
            F.sum("n_words").alias("__w"),
        )
        return sums.select(
            *key,
            _shares(F.col("__cs"), F.col("__c")).alias("__ref_classes"),
            _shares(F.col("__ws"), F.col("__w")).alias("__ref_words"),
        )

    by_lang = stage(pooled(sound, "__lang"), "quality-references")
    everything = pooled(sound.withColumn("__all", F.lit(1)), "__all").select(
        F.col("__ref_classes").alias("__all_classes"), F.col("__ref_words").alias("__all_words")
    )
    pool = everything.first()
    whole = [
        F.array(*[F.lit(float(x)) for x in pool[c]]) if pool else F.lit(None)
        for c in ("__all_classes", "__all_words")
    ]
    held = rows.join(by_lang, "__lang", "left").select(
        *rows.columns,
        F.coalesce("__ref_classes", whole[0]).cast("array<double>").alias("__ref_classes"),
        F.coalesce("__ref_words", whole[1]).cast("array<double>").alias("__ref_words"),
    )
    long_enough = F.col("n_words") >= least_words
    by_class = distance(_shares(F.col("__classes"), F.col("__chars")), F.col("__ref_classes"))
    by_word = distance(_shares(F.col("__common"), F.col("n_words")), F.col("__ref_words"))
    near = (F.col("class_distance") <= most_classes) & (F.col("word_distance") <= most_words)
    return (
        held.withColumn("class_distance", F.when(long_enough, by_class))
        .withColumn("word_distance", F.when(long_enough, by_word))
        .select(
            F.col("__id").alias(id_col),
            F.col("__lang").alias(lang_col),
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "class_distance",
            "word_distance",
            (~F.col("base_failed") & F.coalesce(near, F.lit(True))).alias("kept"),
        )
    )
