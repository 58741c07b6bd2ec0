"""Benchmark decontamination by template windows: questions are found again with other numbers, names and units.

Texts become templates in which numbers, names and units are typed placeholders. Windows of five
template tokens are joined by hash with those of the benchmark; a question counts as found if at least four fifths of its
windows stand in the document and its slots are consistent: along one alignment, each value of the
question goes to one value of the document. All of it is DataFrame operations.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.session import materialize

WINDOW, MIN_CONTAINED = 5, 0.8
#: Benchmark windows that are sent to all tasks at most (some 30 MB); beyond it both sides are shuffled.
SENT_WINDOWS = 1_000_000

#: The template tokens: private characters that stand for a number, its unit (that may be none) and a name; the last ends a value.
NUM, UNIT, NAME, END = "\ue000", "\ue001", "\ue002", "\ue003"
# Units after a number.
UNITS = (
    "km m cm mm miles mile meters meter metres metre feet foot inches inch kg g mg tons ton pounds pound lbs lb ounces ounce l ml "
    "liters liter litres litre hours hour h minutes minute min seconds second s days day d weeks week months month years year "
    "dollars dollar euros euro cents cent percent degrees degree mph watts watt volts volt".split()
)
#: A number with its unit. A name is one or more capitalized words within a sentence. Repetitions are possessive (``*+``):
#: nothing after them needs backtracking, and the matcher then walks long lists without recursion.
NUMBER = rf"(\d+(?:[.,]\d+)*+)(?:\s*({'|'.join(UNITS)})\b)?"
CAPITALS = r"([^.!?:\s][ \t])(\p{Lu}\p{Ll}\p{L}*(?:[ \t]\p{Lu}\p{Ll}\p{L}*)*+)"
BETWEEN = rf"[^\p{{L}}\p{{M}}{NUM}-{NAME}]+"
TOKEN = rf"[{NUM}-{NAME}][^{END}]*{END}|[\p{{L}}\p{{M}}]+"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for a row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _bare(text: Column) -> Column:
    """The text without the private characters used here."""
    marks = [F.contains(text, F.lit(c)) for c in (NUM, UNIT, NAME, END)]
    marked = marks[0] | marks[1] | marks[2] | marks[3]
    return F.coalesce(F.when(marked, F.translate(text, NUM + UNIT + NAME + END, "")).otherwise(text), F.lit(""))


def template(text: Column) -> Column:
    """The template tokens of a text in order; a null text has none."""
    bare = _bare(text)
    named = F.regexp_replace(bare, CAPITALS, f"$1 {NAME} ")
    typed = F.lower(F.regexp_replace(named, NUMBER, f" {NUM} {UNIT} "))
    return F.array_remove(F.split(typed, BETWEEN), "")


def valued(text: Column) -> Column:
    """The same tokens with the value behind each placeholder; a word is the token itself."""
    bare = _bare(text)
    named = F.regexp_replace(bare, CAPITALS, f"$1 {NAME}$2{END} ")
    typed = F.lower(F.regexp_replace(named, NUMBER, f" {NUM}$1{END} {UNIT}$2{END} "))
    return F.regexp_extract_all(typed, F.lit(TOKEN), F.lit(0))


def windows(tokens: Column, size: int) -> Column:
    """The hash of each window of ``size`` template tokens, in order."""

    def of(kinds: Column) -> Column:
        places = F.when(F.size(kinds) >= size, F.sequence(F.lit(0), F.size(kinds) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(*[kinds[i + j] for j in range(size)]))

    return _let(tokens, of)


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item_id, values, n_windows, size, hash, j)``: a question shorter than a window is one window."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("item_id"), template(F.col(text_col)).alias("tokens"), valued(F.col(text_col)).alias("values")
    )
    items = items.dropDuplicates(["item_id", "values"]).where(F.size("tokens") > 0)
    items = items.withColumn("size", F.least(F.size("tokens"), F.lit(WINDOW)))
    hashes = F.lit(None)
    for size in range(1, WINDOW + 1):
        hashes = F.when(F.col("size") == size, windows(F.col("tokens"), size)).otherwise(hashes)
    return items.withColumn("hashes", hashes).select(
        "item_id", "values", F.size("hashes").alias("n_windows"), "size", F.posexplode("hashes").alias("j", "hash")
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_contained: float = MIN_CONTAINED,
) -> DataFrame:
    """``(doc_id, item_id, n_windows, n_matched, n_slots, changed)``: the questions each document contains.

    ``n_slots`` are the distinct values of the question in placeholders of matched windows, ``changed`` tells whether
    any has another value in the document. Questions without tokens and texts that are null or empty match nothing;
    repeated rows of an id count once; of questions with one id and several texts each is looked for. Empty tables give no rows.
    """
    spark = docs.sparkSession
    wanted = benchmark_windows(benchmark, item_col, item_text_col)
    stats = wanted.agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes")).first()  # sizes: 1 to 5
    key = F.xxhash64("values").alias("text_key")
    target = wanted.select("item_id", key, "n_windows", "size", "hash", "j")
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    sizes = sorted(stats["sizes"]) or [WINDOW]
    # the template once for all window sizes; a Python loop over at most five sizes
    sized = F.array(
        *[F.struct(F.lit(s).alias("size"), windows(F.col("_tokens"), s).alias("hashes")) for s in sizes]
    ) if len(sizes) > 1 else None
    cut = texts.select("doc_id", template(F.col("_text")).alias("_tokens"))
    if sized is None:
        found = cut.select("doc_id", F.lit(sizes[0]).alias("size"), F.posexplode(windows(F.col("_tokens"), sizes[0])).alias("i", "hash"))
    else:
        each = cut.select("doc_id", F.explode(sized).alias("w"))
        found = each.select("doc_id", F.col("w.size").alias("size"), F.posexplode("w.hashes").alias("i", "hash"))
    side = F.broadcast(target) if stats["n"] <= SENT_WINDOWS else target
    hits = found.join(side, ["size", "hash"]).select("doc_id", "item_id", "text_key", "n_windows", "size", "i", "j")
    # enough windows on any alignment, then alignment by alignment
    lines = hits.groupBy("doc_id", "item_id", "text_key", (F.col("i") - F.col("j")).alias("shift")).agg(
        F.max("n_windows").alias("n_windows"), F.max("size").alias("size"), F.collect_set("j").alias("js")
    )
    lines = materialize(lines, "template-hits")
    per_pair = lines.groupBy("doc_id", "item_id", "text_key").agg(F.sum(F.size("js")).alias("most"), F.max("n_windows").alias("of"))
    pairs = per_pair.where(F.col("most") >= F.col("of") * min_contained).select("doc_id", "item_id", "text_key")
    lines = lines.join(pairs, ["doc_id", "item_id", "text_key"])
    questions = wanted.where("j = 0").select("item_id", key, F.col("values").alias("q"))
    lines = lines.join(questions, ["item_id", "text_key"])
    at = F.array_distinct(F.flatten(F.transform("js", lambda j: F.sequence(j, j + F.col("size") - 1))))
    lines = lines.withColumn("at", at)
    aligned = lines.join(texts, "doc_id").withColumn("d", valued(F.col("_text"))).drop("_text")
    slots = _let(
        F.struct("q", "d", "shift", "at"),
        lambda s: F.array_distinct(
            F.transform(
                F.filter(
                    s["at"],
                    lambda p: F.substring(s["q"][p], 1, 1).isin(NUM, NAME, UNIT),
                ),
                lambda p: F.struct(s["q"][p].alias("q"), F.get(s["d"], p + s["shift"]).alias("d")),
            )
        ),
    )
    checked = aligned.select("doc_id", "item_id", "text_key", "n_windows", "js", slots.alias("slots"))
    checked = checked.withColumn("values", F.size(F.array_distinct(F.transform("slots", lambda s: s["q"]))))
    sound = checked.where(F.size("slots") == F.col("values")).select(
        "doc_id", "item_id", "text_key", "n_windows", F.explode("js").alias("j"), "values",
        F.exists("slots", lambda s: s["q"] != s["d"]).alias("changed"),
    )
    whole = sound.groupBy("doc_id", "item_id", "text_key").agg(
        F.max("n_windows").alias("n_windows"),
        F.count_distinct("j").alias("n_matched"),
        F.max("values").alias("n_slots"),
        F.max("changed").alias("changed"),
    )
    whole = whole.where(F.col("n_matched") >= F.col("n_windows") * min_contained)
    return whole.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_matched", "n_windows", "n_slots", "changed")).alias("best")
    ).select(
        "doc_id", "item_id", F.col("best.n_windows").alias("n_windows"), F.col("best.n_matched").alias("n_matched"), F.col("best.n_slots"), "best.changed"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no question of the benchmark; rows without an id stay."""
    found = leaks(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(found, id_col, "left_anti")
