"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

Everything is DataFrame functions and Spark's own ML transformers: the n-grams are array functions, ``HashingTF`` hashes them
and ``LogisticRegression`` is fitted on a small labelled table of URLs (``labelled``; ``seed_urls`` is the default).

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``, ``#`` or the
end. A null URL, or one without ``://``, has neither, is under no rule and is judged by the model on no n-grams. A rule fits its
host and all its subdomains if the path starts with the rule's; the longest rule wins (of equal ones, the first given).
Repeated rows give repeated results; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgrid.llm.common import held

#: (host/path, verdict) as the contract has them.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of the labelled table, by the topics of public block lists: gambling, medicines, sex, advertising, fraud; and neutral ones, some
#: of which hold a word of the first kind.
BLOCK_WORDS = (
    "poker", "roulette", "jackpot", "slots", "wager", "lottery", "bingo", "blackjack", "baccarat", "gambling", "sportsbook",
    "pharmacy", "viagra", "cialis", "steroids", "slimming", "painkillers", "levitra", "tramadol",
    "porn", "sex", "nude", "escort", "webcam", "erotic", "hentai", "fetish", "naked",
    "popunder", "clickbait", "affiliate", "banners", "doubleclick", "retarget", "telemetry", "sponsored",
    "phish", "malware", "warez", "keygen", "payday", "scam", "crackz", "counterfeit", "forex", "ponzi",
)
NEUTRAL_WORDS = (
    "news", "library", "museum", "garden", "recipes", "weather", "history", "science", "forum", "docs", "travel", "music", "school",
    "city", "books", "sports", "blog", "shop", "mail", "cloud", "health", "market", "river", "photo", "data", "wiki", "help", "about",
    "press", "radio", "video", "bank", "bonus", "deal", "link", "best", "top", "online", "club", "store", "guide", "daily", "world",
    "essex", "sussex", "scampi", "nutcracker", "banner", "bookmaker", "pharaoh", "escorial", "telemeter", "webcomic", "click", "double",
)


def _made_up(n: int) -> list[str]:
    """Words without a meaning, as most names of hosts are."""
    rnd = random.Random(41)
    starts, vowels, ends = ("b", "c", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "t", "v", "w", "st", "th", "tr", "ch", ""), ("a", "e", "i", "o", "u", "ea", "io", "ou"), ("", "", "n", "r", "s", "t", "l", "nd", "st", "ng", "th")
    return ["".join(rnd.choice(starts) + rnd.choice(vowels) + rnd.choice(ends) for _ in range(rnd.randint(1, 4))) for _ in range(n)]


def seed_urls(spark: SparkSession, block_words: tuple[str, ...] = BLOCK_WORDS) -> DataFrame:
    """A small labelled table (url, label; 1 is block). A blocked URL has a word of BLOCK_WORDS in its host or path, alone or
    joined to any other word; the others have neutral or made-up words in the same places, so that neither the shapes nor the
    words beside say anything."""
    rnd = random.Random(17)
    others = [*NEUTRAL_WORDS, *_made_up(600)]
    tops, tongues = ("com", "net", "org", "info"), ("en", "fr", "de", "es")
    joins = ("{a}-{b}", "{a}{b}", "{b}-{a}", "{b}{a}", "{a}", "{a}{n}")
    places = ("https://www.{x}.example.{t}/{g}/{n}", "http://{x}.{t}/", "https://{x}.example.{t}/{g}/{n}.html", "http://{o}.{x}.{t}/{g}/{p}", "https://{o}.example.{t}/{x}/{n}", "https://{o}.{t}/{g}/{x}.html")

    def url(word: str) -> str:
        name = rnd.choice(joins).format(a=word, b=rnd.choice(others), n=rnd.randint(1, 999))
        return rnd.choice(places).format(x=name, o=rnd.choice(others), p=rnd.choice(others), t=rnd.choice(tops), g=rnd.choice(tongues), n=rnd.randint(1, 9999))

    rows = [(url(w), 1) for w in block_words for _ in range(30)] + [(url(w), 0) for w in others for _ in range(6)]
    return spark.createDataFrame(rows, "url string, label int").coalesce(1)  # it is small


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(after, "^[^/?#]*", 0), F.lit(""))
    rest = F.coalesce(F.substring(after, F.length(host) + 1, F.length(url)), F.lit(""))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^?#]*", 0)


def by_rules(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, said in sorted(reversed(rules), key=lambda r: len(r[0])):  # a later one takes precedence
        of_host, slash, of_path = name.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + of_path)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, told apart by a prefix, with marks at the host's and path's ends."""

    def one(prefix: str, text: Column, n: int) -> Column:
        places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.lit(prefix), F.substring(text, i, F.lit(n))))

    return F.concat(*[one(prefix, text, n) for prefix, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(path, F.lit("$")))) for n in GRAMS])


def fit(labelled: DataFrame) -> PipelineModel:
    """labelled: (url, label), label 1 for block."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("url is not null and label in (0, 1)").select(F.col("label").cast("double").alias("label"), grams(host, path).alias("grams"))
    steps = [HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="hashed"), LogisticRegression(featuresCol="hashed", labelCol="label", regParam=0.01, maxIter=40, standardization=False)]
    return Pipeline(stages=steps).fit(rows)


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: tuple[tuple[str, str], ...] = RULES, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """id, host, path, rule, verdict, score (the model's chance of block)."""
    model = fit(labelled if labelled is not None else seed_urls(pages.sparkSession))
    url = F.col("url")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    host, path = host_and_path(url)
    rows = held(held(rows, "host", host), "path", path).select("page_id", "host", "path")
    rows = rows.withColumn("grams", grams(F.col("host"), F.col("path")))
    scored = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    said = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("page_id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, said).alias("verdict"), "score")
