"""How quality filters overlap: what each removes, repeats and costs, in every order in which they can be applied.

Four filters look at one text; the fifth asks whether a smaller id has the same text. That question is an existential
self-join: a left-semi join on the text's hash, the exact text and a smaller id. What fails is united, and the bits of a
document are combined; all 120 orders then follow from at most 32 counts per part, so that no document is read per order.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ordering import attach
from .common import stored, whole_text

FILTERS = "ABCDE"
BITS = {letter: 1 << i for i, letter in enumerate(FILTERS)}
COPIES_A_TASK = 256
"""Rows of one text are dealt over tasks in lots of about so many; each lot gets its own copy of the joined row."""
_WORD = r"([^\x20\x09-\x0D]+)"


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: few words, few distinct words, much upper case, odd symbols."""
    words = F.regexp_extract_all(text, F.lit(_WORD))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {"A": n < 50, "B": 100 * distinct < 65 * n, "C": 100 * upper > 5 * F.length(text), "D": text.rlike("[#$%&*|]")}
    return sum((F.when(f, F.lit(BITS[k])).otherwise(F.lit(0)) for k, f in fails.items()), F.lit(0))


def repeated_texts(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """Rows (doc_id, part, h) of docs whose exact text also stands at a smaller doc_id.

    docs holds doc_id, part, h (hash of the text) and text, hashes the stored doc_id and h of the same rows. Only texts whose
    hash occurs more than once are moved. The rows of a hot text are dealt over many tasks.
    """
    often = stored(hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select("h", F.ceil(F.col("n") / COPIES_A_TASK).cast("int").alias("lots")), "repeated")
    # The number is given at the scan, where a repeated task gives the same one.
    rows = attach(docs.withColumn("nth", F.monotonically_increasing_id()), often, "h", "inner", null_safe=False)
    later = rows.withColumn("lot", F.pmod(F.xxhash64("nth"), F.col("lots")))
    earlier = rows.groupBy("h", "text").agg(F.min("doc_id").alias("least"), F.max("lots").alias("lots")).select(
        F.col("h").alias("h2"), F.col("text").alias("text2"), "least", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot2"))
    same = (F.col("h") == F.col("h2")) & (F.col("lot") == F.col("lot2")) & (F.col("text") == F.col("text2")) & (F.col("least") < F.col("doc_id"))
    return later.join(earlier, same, "left_semi").select("doc_id", "part", "h")


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, bits, n, good, toxic): rows per part and combination of failed filters, and how many of them are labelled good
    or toxic. A row per combination that occurs."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                        F.xxhash64(whole_text()).alias("h"), whole_text().alias("text"))
    rows = stored(texts.select("doc_id", "part", "h", text_failures(F.col("text")).alias("bits")), "failures")
    again = repeated_texts(texts, rows.select("doc_id", "h"))
    failed = rows.withColumn("n", F.lit(1)).unionByName(again.withColumns({"bits": F.lit(BITS["E"]), "n": F.lit(0)}))
    # Rows that agree in id, part and text fail the same filters: they are one group, counted n times.
    combined = failed.groupBy("doc_id", "part", "h").agg(F.sum("n").alias("n"), F.bit_or("bits").alias("bits"))
    marks = stored(labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality").cast("int") == 1).alias("is_good"), F.max(F.col("toxic").cast("int") == 1).alias("is_toxic")), "marks")
    marked = attach(combined, marks, "doc_id", null_safe=False)
    return marked.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part, every
    order of the filters and every step.

    A missing text is empty, a missing part the empty text. A missing doc_id is smaller than none and has none smaller: such a
    row never fails E. Rows that repeat a doc_id and its text are counted each and fail E only by a smaller id. A document that
    labels names more than once is good (toxic) if any of these rows says so; a missing label says nothing. Without documents
    there are no parts and no rows. Other columns are not read.
    """
    counts = failure_counts(docs, labels, part).groupBy("part").agg(
        F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("groups"))
    orders = F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])
    steps = (counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
             .withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1))))
    bit = sum((F.when(F.col("letter") == k, F.lit(b)).otherwise(F.lit(0)) for k, b in BITS.items()), F.lit(0))
    before = sum((F.when(F.instr("filter_order", k) < F.col("step"), F.lit(b)).otherwise(F.lit(0)) for k, b in BITS.items()), F.lit(0))
    steps = steps.withColumns({"bit": bit, "before": before})

    def total(what: str, holds) -> Column:
        chosen = F.filter("groups", lambda g: holds(g["bits"]))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda a, g: a + g[what])

    def here(bits):
        return (bits.bitwiseAND(F.col("bit")) != 0) & (bits.bitwiseAND(F.col("before")) == 0)

    orders_each = 1
    for i in range(2, len(FILTERS) + 1):
        orders_each *= i
    # In the orders of all filters each of a document's failures comes first equally often.
    first = F.aggregate(F.filter("groups", lambda g: g["bits"].bitwiseAND(F.col("bit")) != 0), F.lit(0).cast("long"),
                        lambda a, g: a + (g["n"] * orders_each / F.bit_count(g["bits"])).cast("long"))
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda b: b.bitwiseAND(F.col("bit").bitwiseOR(F.col("before"))) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda b: (b.bitwiseAND(F.col("bit")) != 0) & (b.bitwiseAND(F.col("before")) != 0)).alias("redundant"),
        total("n", lambda b: b == F.col("bit")).alias("unique_fails"),
        total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"), first.alias("shapley"))
