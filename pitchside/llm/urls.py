"""URL filter: explicit rules first, else a logistic regression on hashed
character n-grams of host and path.

Native: SQL expressions and the DataFrame machine-learning pipeline on the
JVM. The model is fitted once per call on a small labelled table of
(url, blocked) rows; ``LABELLED_LIMIT`` bounds it and is checked. Scoring
needs no shuffle: hashing is a projection and the fitted weights are one
vector of ``features`` numbers.

Defined results: a null url or one without ``://`` has an empty host and
path, matches no rule and gets the verdict of the model's intercept;
repeated rows are judged alike; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .exprs import let

# Rules of the query (fixed values): verdict, host and path prefix.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
LABELLED_LIMIT = 10_000
FEATURES = 1 << 14
GRAMS = (3, 4, 5)

# Seeds of the labelled table: host labels seen on blocked and on ordinary sites.
BLOCKED_LABELS = """casino-win casino poker-room big-slots jackpot free-bets bets-online sportsbet lottery-win
cheap-pills pills-shop pharma-sale viagra-store adult-x adult-video xxx-tube porn-hub sex-cams hot-dates escort-city
spam-farm link-farm seo-spam click-bait ads-track adserver ad-tracker tracker-pixel popup-ads malware-site phish-login
warez-crack free-money win-prizes fast-loans crypto-scam replica-watches""".split()
ORDINARY_LABELS = """news daily-times weather library university college museum archive history science physics
biology chemistry geography travel recipes kitchen garden music concerts theatre cinema books poetry sport football
tennis health hospital clinic school teachers students council city-hall transport railways airport maps photos
gallery design studio software manuals docs wiki forum community market bakery hotel island mountain river forest
thering therand tionble ththing onerea interes entation anderen leseau mentiones ciudades verlag schule strasse""".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: every seed under a few prefixes and paths."""
    rows = []
    for blocked, labels in ((1.0, BLOCKED_LABELS), (0.0, ORDINARY_LABELS)):
        for n, label in enumerate(labels):
            for k, prefix in enumerate(("", "www.", "m.", "blog.")):
                top = ("com", "net", "org")[(n + k) % 3]
                path = ("/en/12", "/de/345.html", "/fr/6/", "/es/78?page=2", "/")[(n + k) % 5]
                rows.append((f"https://{prefix}{label}.example.{top}{path}", blocked))
    return spark.createDataFrame(rows, "url string, blocked double")


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)?", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def with_parts(rows: DataFrame) -> DataFrame:
    """Add ``__host`` and ``__path`` of the column ``url``."""
    rows = rows.withColumn("__url", F.coalesce(F.col("url").cast("string"), F.lit("")))
    host, path = host_and_path(F.col("__url"))
    return rows.withColumns({"__host": host, "__path": path}).drop("__url")


def grams_of(host: Column, path: Column) -> Column:
    """Character n-grams, marked by the part of the url they come from."""
    def grams(text: Column, mark: str) -> list[Column]:
        return [F.when(F.char_length(text) >= n, F.transform(
            F.sequence(F.lit(1), F.char_length(text) - n + 1),
            lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))
            for n in GRAMS]
    marked_host = F.when(host != "", F.concat(F.lit("^"), host, F.lit("$"))).otherwise("")
    return F.concat(*let_parts(marked_host, path, grams))


def let_parts(host: Column, path: Column, grams) -> list[Column]:
    return [let(host, lambda h: F.concat(*grams(h, "h"))), let(path, lambda p: F.concat(*grams(p, "p")))]


def rule_of(host: Column, path: Column, rules=None) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    fitting = []
    for verdict, rule in sorted(rules or RULES, key=lambda r: -len(r[1])):
        name, _, prefix = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + prefix))
        fitting.append((fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    first, value = fitting[0]
    return reduce(lambda c, x: c.when(*x), fitting[1:], F.when(first, value))


def fit(labelled: DataFrame, features: int = FEATURES, limit: int = LABELLED_LIMIT):
    """(hashing, model) fitted on a labelled table of at most ``limit`` rows."""
    if labelled.limit(limit + 1).count() > limit:
        raise ValueError(f"the labelled table has more than {limit} rows")
    hashing = HashingTF(inputCol="__grams", outputCol="__features", numFeatures=features, binary=True)
    rows = with_parts(labelled).withColumn("__grams", grams_of(F.col("__host"), F.col("__path")))
    regression = LogisticRegression(featuresCol="__features", labelCol="blocked", regParam=0.01, maxIter=60,
                                    probabilityCol="__probability", rawPredictionCol="__raw",
                                    predictionCol="__prediction")
    return hashing, regression.fit(hashing.transform(rows).coalesce(1))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules=None, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score of each url."""
    hashing, model = fit(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    rows = with_parts(pages.select("page_id", "url")).withColumn("__rule", rule_of(F.col("__host"), F.col("__path"), rules))
    rows = rows.withColumn("__grams", grams_of(F.col("__host"), F.col("__path")))
    scored = model.transform(hashing.transform(rows))
    score = F.get(vector_to_array("__probability"), F.lit(1))
    return scored.select(
        "page_id", F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule.rule").alias("rule"),
        F.coalesce(F.col("__rule.verdict"), F.when(score > threshold, "block").otherwise("allow")).alias("verdict"),
        F.round(score, 9).alias("score"))
