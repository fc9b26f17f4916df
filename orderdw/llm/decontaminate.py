"""Benchmark decontamination with spaced seeds (operator 6).

A mask of ones and zeros slides over the words of every text; words under zeros are ignored, so a
changed word there does not hide the rest. The masked words of the test items are hashed and joined
with those of all documents. Each hit fixes a diagonal (how far the item is shifted against the
document). The words of the documents that were hit are then fetched once and compared along the
diagonal: an item is there when SHARE of its words are, or when a run of words reaches a score, where
equal words count MATCH and different ones MISMATCH. All of this is built-in functions; no Python
code sees a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdw.llm.common import table
from orderdw.session import cut_lineage

# Masks by the number of words an item must have. Long items have room for a wide mask somewhere
# between their changes; short ones need narrow masks; those of one to three words are looked for
# as they are.
MASKS = ((12, "11011011"), (12, "11101101"), (12, "10110111"),
         (4, "11011"), (4, "10111"), (4, "11101"), (4, "1111"), (3, "111"), (2, "11"), (1, "1"))
MATCH, MISMATCH, SCORE, SHARE = 1, -2, 12, 0.8
# The hashes of the test items are sent to all executors up to so many rows (24 bytes each);
# beyond that both sides are shuffled.
BROADCAST_ROWS = 1_000_000
NOT_WORD = r"[^\p{L}\p{N}]+"


def words_of(text: str = "text") -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), NOT_WORD), lambda w: w != "")


def least_words(n: Column) -> Column:
    """Of the numbers of words that masks are for, the largest that ``n`` words reach."""
    kinds = sorted({least for least, _ in MASKS})
    return F.greatest(*[F.when(n >= least, F.lit(least)).otherwise(0) for least in kinds])


def seeds(worded: DataFrame, kinds: Sequence[int], keep: Sequence[str],
          own: Column | None = None) -> DataFrame:
    """``worded`` (with an array column words) repeated for each position (at) and each mask for one
    of ``kinds`` numbers of words, or for the row's ``own`` only: the hash of the masked words in
    column seed. Of the other columns, ``keep`` stay."""
    hashes = []
    for number, (least, mask) in enumerate(MASKS):
        if least in kinds:
            under = [F.get("words", F.col("at") + i) for i, bit in enumerate(mask) if bit == "1"]
            fits = F.col("at") + len(mask) <= F.size("words")
            fits = fits if own is None else fits & (own == least)
            hashes.append(F.when(fits, F.xxhash64(F.lit(number), *under)))
    if not hashes:
        return worded.select(*keep, F.lit(0).alias("at"), F.lit(0).cast("long").alias("seed")).limit(0)
    last = F.greatest(F.size("words") - 1, F.lit(0))
    placed = worded.withColumn("at", F.explode(F.sequence(F.lit(0), last)))
    return placed.select(*keep, "at", F.stack(F.lit(len(hashes)), *hashes).alias("seed")).filter(
        "seed IS NOT NULL")


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, shift, n_words, n_same, score): which documents hold which items.

    An item is found on a diagonal where SHARE of its words are equal, or where the best run of words
    scores at least SCORE, or SHARE of its words if it is shorter: +1 for an equal word, -2 for
    another one. ``shift`` is the document's word at the item's first, ``n_same`` the number of equal
    words on the diagonal, both for the best diagonal (score, then the smallest shift). Items of one
    to three words are found as they are, so a single common word is found wherever it stands. Rows
    without an id, and null or wordless texts, take no part; repeated rows give one result.
    """
    found = F.struct("shift", "n_words", "n_same", "score")
    best = _scored(docs, items).groupBy("doc_id", "item_id").agg(F.max_by(
        found, F.struct("score", -F.col("shift"), "n_words")).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def _scored(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The diagonals that count, with their score."""
    listed = (items.filter("item_id is not null").select("item_id", words_of().alias("words"))
              .filter(F.size("words") > 0).distinct()
              .withColumn("item", F.xxhash64("item_id", "words"))
              .withColumn("kind", least_words(F.size("words"))))
    every = sorted({least for least, _ in MASKS})
    wanted = cut_lineage(seeds(listed, every, ("item", "kind"), F.col("kind")).select(
        "seed", "item", "kind", F.col("at").alias("item_at")), "item-seeds")
    # Documents get the seeds that some item can have.
    kinds = [r.kind for r in wanted.select("kind").distinct().collect()]
    wanted = wanted.drop("kind")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    worded = docs.filter("doc_id is not null").select(
        "doc_id", F.xxhash64("text").alias("tid"), words_of().alias("words"))
    hits = (seeds(worded, kinds, ("doc_id", "tid")).join(wanted, "seed")
            .select("doc_id", "tid", "item", (F.col("at") - F.col("item_at")).alias("shift"))
            .distinct())
    hits = cut_lineage(hits, "seed-hits")
    lines = hits.join(listed.select("item", F.size("words").alias("n_words")), "item")
    if hits.count() <= BROADCAST_ROWS:
        lines = F.broadcast(lines)
    # Each diagonal takes the words that it needs out of its document where the two meet.
    low = F.greatest(F.col("shift"), F.lit(0))
    high = F.least(F.size("words"), F.col("shift") + F.col("n_words"))
    lined = (worded.join(lines, ["doc_id", "tid"])
             .select("doc_id", "tid", "item", "shift", "n_words",
                     F.slice("words", low + 1, high - low).alias("part")).join(listed, "item"))
    start = F.greatest(-F.col("shift"), F.lit(0))
    same = F.transform("part", lambda w, i: w == F.get("words", i + start))
    run = F.aggregate(
        "same", F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")),
        lambda a, hit: F.struct(
            F.greatest(F.lit(0), a["now"] + F.when(hit, MATCH).otherwise(MISMATCH)).alias("now"),
            F.greatest(a["best"], a["now"] + F.when(hit, MATCH).otherwise(MISMATCH)).alias("best")),
        lambda a: a["best"])
    enough = F.ceil(SHARE * F.col("n_words"))
    return (lined.withColumn("same", same).withColumn("score", run)
            .withColumn("n_same", F.size(F.filter("same", lambda x: x)))
            .filter((F.col("score") >= F.least(F.lit(SCORE), enough))
                    | (F.col("n_same") >= enough)))


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the texts that hold an item. Rows without a doc_id stay, and so does a clean
    text whose doc_id another text has too."""
    leaked = _scored(docs, items).select("doc_id", F.col("tid").alias("_tid")).distinct()
    return (docs.withColumn("_tid", F.xxhash64("text"))
            .join(leaked, ["doc_id", "_tid"], "left_anti").select(docs.columns))


def op6_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """All benchmark items in all documents."""
    return overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _sql_seeds(source: str, least: str | None = None) -> str:
    """Seeds of all masks, or of those for ``least`` words."""
    cases = []
    for number, (words, mask) in enumerate(MASKS):
        under = ", ".join(f"words[i + {k + 1}]" for k, bit in enumerate(mask) if bit == "1")
        mine = f" AND {least} = {words}" if least else ""
        cases.append(f"CASE WHEN i + {len(mask)} <= len(words){mine} "
                     f"THEN concat_ws(' ', '{number}', {under}) END")
    return (f"SELECT * FROM (SELECT * EXCLUDE (words), unnest([{', '.join(cases)}]) AS seed FROM "
            f"(SELECT *, unnest(range(len(words))) AS i FROM {source})) WHERE seed IS NOT NULL")


_KIND = " ".join(f"WHEN len(words) >= {least} THEN {least}"
                 for least in sorted({least for least, _ in MASKS}, reverse=True))

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(coalesce(text, '')),
                           '[^\p{{L}}\p{{N}}]+') IF w <> ''] AS words FROM documents),
b AS (SELECT item_id, [w FOR w IN regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+')
      IF w <> ''] AS words FROM benchmark),
k AS (SELECT *, CASE {_KIND} END AS kind FROM b),
h AS (SELECT DISTINCT x.doc_id, y.item_id, x.i - y.i AS shift
      FROM ({_sql_seeds('d')}) x JOIN ({_sql_seeds('k', 'kind')}) y USING (seed)),
l AS (SELECT h.*, d.words AS dw, b.words AS bw, unnest(range(greatest(-shift, 0),
             least(len(b.words), len(d.words) - shift))) AS k
      FROM h JOIN d USING (doc_id) JOIN b USING (item_id)),
s AS (SELECT doc_id, item_id, shift, len(bw) AS n_words, k, dw[k + shift + 1] = bw[k + 1] AS same
      FROM l),
p AS (SELECT *, sum(CASE WHEN same THEN {MATCH} ELSE {MISMATCH} END)
      OVER (PARTITION BY doc_id, item_id, shift ORDER BY k) AS total FROM s),
q AS (SELECT *, total - least(0, coalesce(min(total) OVER (PARTITION BY doc_id, item_id, shift
      ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS run FROM p),
t AS (SELECT doc_id, item_id, CAST(shift AS INT) AS shift, CAST(n_words AS INT) AS n_words,
             CAST(count(*) FILTER (WHERE same) AS INT) AS n_same,
             CAST(greatest(max(run), 0) AS INT) AS score
      FROM q GROUP BY ALL),
u AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY score DESC, shift) AS place
      FROM t WHERE score >= least({SCORE}, ceil({SHARE} * n_words))
                OR n_same >= ceil({SHARE} * n_words))
SELECT doc_id, item_id, shift, n_words, n_same, score FROM u WHERE place = 1
"""
