"""URL filter: rules, host word segmentation and naive Bayes (operator 7).

Work is done once per distinct (host, path). Rules fit a host and its subdomains: the host's suffixes
join the rules by equality, then the longest rule whose path starts the url's path wins. For the
rest, concatenated host names are cut into words by a unigram Viterbi search whose word counts come
from the whole text of all pages: the names' bounded substrings join the words by equality, and each
name's edges are folded from left to right. A multinomial naive Bayes model over the words of host
and path, trained on the urls that the rules decide, gives the other verdicts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdw.llm.common import ascii_lower, table
from orderdw.session import cut_lineage

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))
# Words taken to stand for unwanted sites until urls show otherwise, and in how many blocked urls each
# of them counts as seen beforehand.
BLOCK_WORDS = ("adult", "bet", "bets", "casino", "farm", "pills", "poker", "porn", "sex", "spam",
               "viagra", "warez", "win", "xxx")
BLOCK_SEEN = 10
MAX_WORD = 24
NAME = "[a-z]{2,}"


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path; both empty where url is null or has no ``://``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)
    return pages.withColumn("host", ascii_lower(host)).withColumn("path", path)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules such as ``net/`` as (rule, rule_host, rule_path, rule_verdict)."""
    return spark.createDataFrame(
        [(r, r[:r.index("/")], r[r.index("/"):], v) for v, r in rules],
        "rule string, rule_host string, rule_path string, rule_verdict string")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (distinct host, path) with rule and rule_verdict, null where none fits."""
    parts = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(
        F.slice(parts, i, F.size(parts)), "."))
    tried = (urls.select("host", "path", F.explode(suffixes).alias("rule_host"))
             .join(rules, "rule_host").filter(F.startswith("path", "rule_path")))
    best = tried.groupBy("host", "path").agg(F.max_by(
        F.struct("rule", "rule_verdict"), F.struct(F.length("rule"), "rule")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "host", "path", "count", "best.rule", "best.rule_verdict")


def word_counts(pages: DataFrame, wanted: DataFrame) -> tuple[DataFrame, int]:
    """How often each of the ``wanted`` words (piece) occurs in the text of all pages, and the
    number of all words there."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, "[^a-z]+")).alias("piece")).filter("piece <> ''")
    counts = cut_lineage(words.groupBy("piece").count(), "url-words")
    total = counts.agg(F.sum("count")).first()[0] or 0
    return counts.join(wanted, "piece", "left_semi"), total


def segment(name: str, costs: dict[tuple[int, int], float], unknown: Sequence[float]) -> list[str]:
    """The cheapest cut of ``name``; ``costs`` by (start, end), other pieces by their length."""
    best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for start in range(max(0, end - MAX_WORD), end):
            cost = best[start] + costs.get((start, end), unknown[end - start])
            if cost < best[end]:
                best[end], back[end] = cost, start
    words, end = [], len(name)
    while end:
        words.append(name[back[end]:end])
        end = back[end]
    return words[::-1]


def _segments(total: int):
    # A word never seen: ten times less likely with every letter.
    unknown = [0.0] + [math.log(max(total, 1)) + (n - 1) * math.log(10) + math.log(10)
                       for n in range(1, MAX_WORD + 1)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, edges = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cut = [segment(n, {(e["start"], e["end"]): math.log(max(total, 1) / e["count"])
                               for e in found or ()}, unknown)
                   for n, found in zip(names, edges, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(cut, pa.list_(pa.string()))],
                ["name", "words"])
    return rows


def segmented(names: DataFrame, pages: DataFrame) -> DataFrame:
    """(name, words) for distinct ``names`` of letters, by a unigram Viterbi search."""
    n = F.length("name")
    starts = names.select("name", F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    pieces = cut_lineage(
        starts.select("name", "start", F.explode(F.sequence(F.lit(1), F.least(
            F.lit(MAX_WORD), n - F.col("start")))).alias("size"))
        .select("name", "start", (F.col("start") + F.col("size")).alias("end"),
                F.expr("substring(name, start + 1, size)").alias("piece")), "url-pieces")
    counts, total = word_counts(pages, pieces.select("piece").distinct())
    edges = (pieces.join(counts, "piece").groupBy("name")
             .agg(F.collect_list(F.struct("start", "end", "count")).alias("edges")))
    return names.join(edges, "name", "left").select("name", "edges").mapInArrow(
        _segments(total), "name string, words array<string>")


def _path_words() -> Column:
    """Words of a path; a run of digits is one sign, for numbers tell pages apart, not sites."""
    return F.filter(F.split(F.regexp_replace(ascii_lower(F.col("path")), "[0-9]+", "#"),
                            "[^a-z#]+"), lambda w: w != "")


def word_ratios(words: DataFrame, block_words: Sequence[str] = BLOCK_WORDS) -> DataFrame:
    """Log of P(word | block) / P(word | allow), by add-one counts over words of decided urls;
    ``block_words`` count as seen in BLOCK_SEEN more blocked urls."""
    seen = words.groupBy("word").agg(
        *[F.sum(F.when(F.col("rule_verdict") == v, F.col("count")).otherwise(0)).alias(v)
          for v in ("block", "allow")])
    seen = seen.withColumn("block", F.col("block") + F.when(
        F.col("word").isin(*block_words), BLOCK_SEEN).otherwise(0))
    sums = seen.agg(F.coalesce(F.sum("block"), F.lit(0)).alias("all_block"),
                    F.coalesce(F.sum("allow"), F.lit(0)).alias("all_allow"),
                    F.count("*").alias("kinds")).first()
    ratio = (F.log((F.col("block") + 1) / (sums["all_block"] + sums["kinds"] + 1))
             - F.log((F.col("allow") + 1) / (sums["all_allow"] + sums["kinds"] + 1)))
    return seen.select("word", ratio.alias("ratio"))


def class_ratio(urls: DataFrame) -> float:
    """Log of P(block) / P(allow), by add-one counts of decided urls."""
    n = urls.agg(*[F.coalesce(F.sum(F.when(F.col("rule_verdict") == v, F.col("count"))), F.lit(0))
                   .alias(v) for v in ("block", "allow")]).first()
    return math.log((n["block"] + 1) / (n["allow"] + 1))


def _label_count(name: Column) -> Column:
    return F.size(F.split(name, "\\."))


def _left_out(suffixes: Sequence[str]) -> Column:
    """How many last labels of a host are no words: its public suffix (the last label, or the longest
    of ``suffixes`` that fits), and what the rule that decided the url names."""
    public = [F.when(F.endswith("host", F.lit(f".{s}")), s.count(".") + 1).otherwise(1)
              for s in suffixes]
    named = F.coalesce(_label_count(F.substring_index("rule", "/", 1)), F.lit(1))
    return F.greatest(F.lit(1), named, *public)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
          suffixes: Sequence[str] = ()) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url, html).

    The longest fitting rule decides, ties to the smaller text. Without one the words decide: block
    if their summed log ratio and that of the classes are above zero, else allow; a url without words
    is allowed. All labels of a host are words but its public suffix (the last label, or
    one of ``suffixes``, such as ``co.uk``) and, in training, what the deciding rule names. Null urls have an empty host and path. Repeated rows repeat; other columns are left out.
    """
    spark = pages.sparkSession
    located = with_host_and_path(pages.select("page_id", "url")).select("page_id", "host", "path")
    urls = cut_lineage(match_rules(located.groupBy("host", "path").count(),
                                   rule_table(spark, rules)), "urls")
    placed = urls.withColumn("left_out", _left_out(suffixes))
    sub = F.array_join(F.slice(F.split("host", "\\."), F.lit(1), F.greatest(
        _label_count(F.col("host")) - F.col("left_out"), F.lit(0))), ".")
    names = F.regexp_extract_all(sub, F.lit(f"({NAME})"), F.lit(1))
    hosts = placed.select("host", "left_out").distinct().withColumn("name", F.explode(names))
    cut = segmented(hosts.select("name").distinct(), pages)
    host_words = hosts.join(cut, "name").select("host", "left_out",
                                                F.explode("words").alias("word"))
    by_host = placed.select("host", "left_out", "path", "count", "rule_verdict").join(
        host_words, ["host", "left_out"])
    by_path = urls.select("host", "path", "count", "rule_verdict",
                          F.explode(_path_words()).alias("word"))
    words = cut_lineage(by_host.select(by_path.columns).unionByName(by_path), "url-tokens")
    ratios = word_ratios(words.filter("rule_verdict is not null").unionByName(
        words.filter("rule_verdict is null").withColumn("count", F.lit(0).cast("long"))))
    scores = (words.filter("rule_verdict is null").join(ratios, "word")
              .groupBy("host", "path").agg((F.sum("ratio") + class_ratio(urls)).alias("score")))
    judged = urls.join(scores, ["host", "path"], "left").select(
        "host", "path", "rule", F.coalesce(
            "rule_verdict", F.when(F.col("score") > 0, "block").otherwise("allow"))
        .alias("verdict"))
    return located.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule",
                                                         "verdict")


def op7_url_words(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: the verdict on every page's url."""
    return judge(table(spark, folder, "pages"))
