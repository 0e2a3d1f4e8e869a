"""Benchmark decontamination with DataFrame functions only.

The benchmark's normalised word windows are a hash set of bounded size; every document position is
hashed over the same number of words and probes the set inside one generated loop; hits are verified
word by word.  Only hits and one row per document are shuffled.

Edge cases: null and empty texts have no words and no hits; an item of fewer than ``window`` words is
one window, an item without words none; equal rows (same doc_id and text) get one row each with the
same result; repeated items count once; an empty benchmark hits nothing; other columns of the
documents are ignored by ``scan`` and pass through ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.common import checked, staged

WINDOW = 10
#: Windows that are broadcast at most (about 200 bytes each); a larger set is joined by shuffle.
SET_ROWS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The separators before a word and the word, in text that is not lower-cased.
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    folded = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


def row_key() -> Column:
    return F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text"))


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """gram (words), item, hash: one row per window and item, staged."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words().alias("w"))
    size = F.size("w")
    starts = F.when(size > 0, F.sequence(F.lit(1), F.greatest(size - (window - 1), F.lit(1))))
    grams = items.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), window).alias("gram"))
    hashed = grams.distinct().withColumn("hash", F.xxhash64(F.col("gram")))
    return staged(hashed, "windows")


def hits(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """key, n_words, at, len, hash: one row with at = 0 per document row, one per verified hit."""
    lengths = [r[0] for r in grams.select(F.size("gram").alias("n")).distinct().orderBy("n").collect()] or [WINDOW]
    bank = staged(grams.select("hash", "gram").distinct(), "window_set")
    base = docs.select(row_key().alias("key"), words().alias("w")).withColumn("n_words", F.size("w"))
    last = F.greatest(F.col("n_words") - (lengths[0] - 1), F.lit(0))
    # the outer form, else Spark derives a filter that splits every text twice
    at = base.select("key", "n_words", "w", F.explode_outer(F.sequence(F.lit(0), last)).alias("at"))

    def probe(n: int) -> Column:
        inside = (F.col("at") > 0) & (F.col("at") + (n - 1) <= F.col("n_words"))
        return F.when(inside, F.xxhash64(F.array(*[F.get("w", F.col("at") + (i - 1)) for i in range(n)])))

    if len(lengths) == 1:
        probed = at.withColumn("len", F.lit(lengths[0])).withColumn("probe", probe(lengths[0]))
    else:
        tries = F.array(*[F.struct(F.lit(n).alias("len"), probe(n).alias("probe")) for n in lengths])
        tried = at.withColumn("_t", F.explode_outer(tries)).select("key", "n_words", "w", "at", "_t.len", "_t.probe")
        probed = tried.filter((F.col("at") > 0) | (F.col("len") == lengths[0]))
    found = probed.join(checked(bank, SET_ROWS), F.col("probe") == F.col("hash"), "left")
    same = F.slice("w", F.col("at"), F.col("len")) == F.col("gram")
    return found.filter((F.col("at") == 0) | (F.col("hash").isNotNull() & same)).select("key", "n_words", "at", "len", "hash")


def covered(spans: Column) -> Column:
    """Words inside any of the ``spans`` (at, len), sorted by at."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, x):
        end = x["at"] + x["len"] - 1
        more = F.greatest(end - F.greatest(acc["end"], x["at"] - 1), F.lit(0))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + more).alias("n"))

    return F.aggregate(spans, zero, add)["n"]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """key, copies (equal rows), n_words, spans (at, len; sorted), items (sorted): one row per distinct document row."""
    grams = windows(benchmark, window)
    span = F.when(F.col("at") > 0, F.struct("at", "len"))
    found = hits(docs, grams).groupBy("key").agg(
        F.count(F.when(F.col("at") == 0, 1)).alias("copies"), F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(span)).alias("spans"), F.collect_set("hash").alias("hashes"),
    )
    found = staged(found, "scanned")
    hit = found.select("key", F.explode("hashes").alias("hash"))
    items = hit.join(checked(grams.select("hash", "item"), SET_ROWS), "hash").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return found.drop("hashes").join(items, "key", "left").withColumn("items", F.coalesce("items", none))


def clean(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", window: int = WINDOW) -> DataFrame:
    """``docs`` without documents that hold a window, or, with mode "spans", without the words of the hits."""
    found = scan(docs, benchmark, window).filter(F.size("spans") > 0).select(F.col("key").alias("hit"), "spans")
    rows = docs.select(F.struct("*").alias("row"), row_key().alias("key"))
    same = F.col("key").eqNullSafe(F.col("hit"))
    if mode == "documents":
        return rows.join(found, same, "left_anti").select("row.*")
    if mode != "spans":
        raise ValueError(f"mode is 'documents' or 'spans', not {mode!r}")
    hit = F.col("spans").isNotNull()
    pieces = F.when(hit, F.regexp_extract_all(F.col("row.text"), F.lit(PIECE), F.lit(0)))
    cut = rows.join(found, same, "left").withColumn("p", pieces)
    # what lies between the ends of the spans so far and the next start
    ends = F.transform(F.sequence(F.lit(1), F.size("spans")), lambda i: F.array_max(F.transform(F.slice("spans", 1, i), lambda x: x["at"] + x["len"])))
    starts = F.concat(F.array(F.lit(1)), ends)
    stops = F.concat(F.transform("spans", lambda x: x["at"]), F.array(F.size("p") + 1))
    gaps = F.zip_with(starts, stops, lambda a, b: F.when(b > a, F.array_join(F.slice(F.col("p"), a, b - a), "")))
    tail = F.expr("substring(row.text, length(array_join(p, '')) + 1)")
    kept = F.concat(F.array_join(F.filter(gaps, lambda g: g.isNotNull()), "\n"), tail)
    text = F.when(hit, kept).otherwise(F.col("row.text"))
    return cut.select(F.col("row").withField("text", text).alias("row")).select("row.*")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    n_hit = covered(F.col("spans"))
    return scan(docs, benchmark).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.col("key.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item, array_to_string(w[p:p + 9], ' ') AS gram, len(w[p:p + 9]) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)
), h AS (
  SELECT rid, p, g.n, g.item
  FROM (SELECT rid, p, m.n, array_to_string(w[p:p + m.n - 1], ' ') AS gram
        FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM w) x JOIN (SELECT DISTINCT n FROM g) m ON p + m.n - 1 <= len(w)) d JOIN g USING (gram, n)
), c AS (
  SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT rid, p, n FROM h)) GROUP BY rid
), i AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (rid) LEFT JOIN i USING (rid)
"""
