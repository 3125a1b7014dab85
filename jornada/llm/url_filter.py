"""URL verdicts by rules and, where no rule fits, by logistic regression.

The model works on hashed character n-grams of host and path and is trained
from a small labelled table of URLs, all with Spark's own expressions and
its JVM-side learner. A fifth of the table sets the threshold.

The host is what follows the first "://" up to "/", "?", "#" or the end, with
A-Z lower-cased; the path follows, up to "?", "#" or the end. A rule such as
"example.org/es/" fits its host and all subdomains if the path starts with the
rule's; the longest rule wins, of equally long ones the first by code point.

Defined results: a null url, or one without "://", has an empty host and path.
Such a page has no n-grams but its edges, and the model lets it through. Rows
are independent, so repeated rows and null ids give repeated results. Other
columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jornada.llm.words import ascii_lower

GRAMS = (3, 4, 5)
FEATURES = 1 << 14
#: One labelled URL in so many is kept from the model, to find the threshold; levels at which that is looked for.
UNSEEN, LEVELS = 5, 1000

# The rules of the query.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# Words of unwanted and of ordinary hosts, and paths, from which the labelled URLs are put together.
UNWANTED_WORDS = (
    "casino poker betting bets jackpot roulette slots lottery gambling bingo adult xxx porn sex nude escort camgirls erotic "
    "pills viagra pharmacy steroids payday loans casher spam backlinks clickbait adserver ads tracker popup banner malware "
    "phishing keygen crack warez torrent replica counterfeit giveaway prize"
).split()
WANTED_WORDS = (
    "library museum university physics garden news weather project recipes forum school hospital travel history science theatre "
    "music maps orchestra chess trains books kitchen parliament birds theory thunder thistle health earth math bath path cloth "
    "north south month mother father brother other another whether gather thread three throat thorn thought youth mouth worth "
    "station nation education tradition edition relation motion action question mention solution population option caption "
    "rathaus buch garten schule wetter zeitung kirche stadt bahnhof verein bibliothek geschichte musik brot berg wald "
    "jardin ecole journal ville gare musee livre cuisine mairie eglise histoire voyage hotel bateau maison "
    "escuela ciudad periodico cocina libro tiempo iglesia historia viaje salud montana playa correo biblioteca mercado "
    "bridge river mountain village market bakery painter carpenter plumber dentist lawyer teacher student farmer fisher "
    "shop store rental repair design studio gallery festival council charity volunteer heritage archive atlas almanac "
    "a x web wiki docs blog home city lake hill stone green blue red summer winter spring autumn"
).split()
PATHS = "about contact visit articles guide season horario index.html archive 12 2024 live buy order download item?id=7 de fr".split()
HOSTS = ("{0}.test", "www.{0}.test", "{0}-{1}.test", "{1}-{0}.test", "blog.{0}{1}.test", "m.{1}{0}.test", "{1}-{0}-{2}.test")


def _urls(words: Sequence[str], others: Sequence[str], times: int) -> tuple[str, ...]:
    """Each word in `times` hosts, alone or among others; paths tell nothing of the kind."""
    found = []
    for turn in range(times):
        for i, word in enumerate(words):
            second, third = (others[(i * 7 + turn * k + k) % len(others)] for k in (3, 11))
            host = HOSTS[(i + turn) % len(HOSTS)].format(word, second, third)
            found.append(f"http{'s' * (i % 2)}://{host}/{PATHS[(i * 5 + turn) % len(PATHS)]}")
    return tuple(dict.fromkeys(found))


#: The labelled URLs of the query: invented hosts. One unwanted word among ordinary ones makes a host unwanted.
UNWANTED = _urls(UNWANTED_WORDS, WANTED_WORDS, 14)
WANTED = (*_urls(WANTED_WORDS, WANTED_WORDS, 7), "http://", "http://a.test", "http://x.test/")


def labelled(spark: SparkSession, unwanted: Sequence[str] = UNWANTED, wanted: Sequence[str] = WANTED) -> DataFrame:
    """A table (url, label) of labelled URLs."""
    rows = [(u, 1.0) for u in unwanted] + [(u, 0.0) for u in wanted]
    listed = F.from_json(F.lit(json.dumps([{"url": u, "label": y} for u, y in rows])), "array<struct<url: string, label: double>>")
    return spark.range(1).select(F.explode(listed).alias("row")).select("row.*")


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url, F.lit(""))
    parts = "://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(text, parts, 1)), F.regexp_extract(text, parts, 2)


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, nulls where none fits; a test per rule of a short list."""
    verdict, rule = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column, lengths: Sequence[int] = GRAMS) -> Column:
    """All n-grams of host and path, each between edge marks, marked with the part they come from."""

    def of(mark: str, text: Column) -> list[Column]:
        whole = F.concat(F.lit(mark + "<"), text, F.lit(">"))

        def cut(n: int) -> Column:
            starts = F.sequence(F.lit(2), F.greatest(F.lit(2), F.length(whole) - n + 1))
            return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(whole, i, F.lit(n))))

        return [cut(n) for n in lengths]

    return F.concat(*of("h", host), *of("p", path))


@dataclass(frozen=True)
class Filter:
    """The model, and the probability from which on it blocks."""

    model: LogisticRegressionModel
    block_from: float

    def probability(self, rows: DataFrame, grams_of: Column, out: str) -> DataFrame:
        """The rows with the probability that they are unwanted."""
        rows = rows.withColumn("_grams", grams_of)
        rows = HashingTF(numFeatures=self.model.numFeatures, inputCol="_grams", outputCol="_features", binary=True).transform(rows)
        model = self.model.copy().setFeaturesCol("_features").setProbabilityCol("_p").setPredictionCol("_y").setRawPredictionCol("_r")
        scored = model.transform(rows).withColumn(out, vector_to_array("_p")[1])
        return scored.drop("_grams", "_features", "_p", "_y", "_r")


def train(labels: DataFrame, features: int = FEATURES) -> Filter:
    """Fits the model to a labelled table (url, label), and its threshold to a fifth of it that the model has not seen.

    The threshold is where the shares of both kinds that are judged right there
    add up to most, and of equally good ones the middle. Where that fifth has
    not both kinds, one half counts.
    """
    known = labels.select("url", F.col("label").cast("double").alias("label")).where("url is not null and label in (0, 1)")
    apart = F.crc32("url") % UNSEEN == 0
    seen, unseen = known.where(~apart), known.where(apart)
    counted = HashingTF(numFeatures=features, inputCol="grams", outputCol="features", binary=True).transform(
        seen.select("label", grams(*host_and_path(F.col("url"))).alias("grams"))
    )
    model = LogisticRegression(maxIter=60, regParam=0.0003, standardization=False).fit(counted)
    found = Filter(model, 0.5)
    scored = found.probability(unseen, grams(*host_and_path(F.col("url"))), "unwanted")
    # At most two numbers per level.
    level = F.floor(F.col("unwanted") * LEVELS).cast("int").alias("level")
    counts = {(r["label"], r["level"]): r["n"] for r in scored.groupBy("label", level).agg(F.count("*").alias("n")).collect()}
    return Filter(model, best_threshold(counts))


def best_threshold(counts: dict[tuple[float, int], int], levels: int = LEVELS) -> float:
    """The probability that parts both kinds best; `counts` are by label and level."""
    total = {y: sum(n for (label, _), n in counts.items() if label == y) for y in (0.0, 1.0)}
    if not all(total.values()):
        return 0.5
    right, sums = 0.0, []
    for level in range(levels + 1):
        right += counts.get((0.0, level - 1), 0) / total[0.0] - counts.get((1.0, level - 1), 0) / total[1.0]
        sums.append(right)
    good = [level for level, x in enumerate(sums) if x > max(sums) - 1e-9]
    return (good[0] + good[-1]) / 2 / levels


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    model: Filter | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's probability that the page is unwanted."""
    model = model or train(labelled(pages.sparkSession))
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = model.probability(rows, grams(F.col("host"), F.col("path")), "unwanted")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    guess = F.when(F.col("unwanted") >= model.block_from, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, guess).alias("verdict"), "unwanted")
