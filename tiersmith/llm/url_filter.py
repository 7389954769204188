"""URL filter: rules for hosts and path prefixes, and a logistic regression where no rule fits.

The regression sees hashed character n-grams of host and path and is trained by Spark ML on a small
labelled table. Scoring is one SQL expression per row: the weights of a row's n-grams are looked up in
an array of ``FEATURES`` numbers, whose size is fixed.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule; its
verdict is the regression's for no n-grams. Among fitting rules the longest wins, host before path.
Rows are judged one by one, so repeated rows get equal results; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = 1 << 14
GRAMS = (3, 4)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


# The rules of the registered query. A rule list is configuration: it becomes one expression.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)

# The labelled urls. Rule: a url is to be blocked if its host or its path is a bad one, so that either part has
# to tell by itself: bad hosts come with ordinary paths, bad paths with ordinary hosts. Both kinds of
# hosts go through the same prefixes and endings, which therefore tell nothing.
ORDINARY = (
    "river garden history museum library recipes news city school weather music letters village forest science travel "
    "kitchen painting teacher morning mountain harbour county theatre journal orchard cycling knitting baking poetry railway astronomy"
).split()
BAD = (
    "casino-bonus ads-server hot-pills free-prize click-tracker xxx-cams poker-bets cheap-loans spam-mail win-lottery "
    "adult-dating track-pixel bets-online pills-shop popup-ads cash-winner"
).split()
PREFIXES, ENDINGS = ["", "www.", "m.", "blog."], ["example", "example.com", "example.org", "example.net"]
# Hyphens tell nothing either: half as many ordinary hosts again are of two words.
ORDINARY += [f"{a}-{b}" for a, b in zip(ORDINARY[:16], ORDINARY[16:])]
BAD += ["casino", "poker", "trackers", "lottery"]
ORDINARY_PATHS = ["/en/2041", "/de/artikel/history-of-rivers.html", "/fr/18220/", "/es/guide/chapter-3", "/article/7731"]
BAD_PATHS = ["/click/redirect", "/promo/bonus-win", "/banner/track.gif", "/buy-cheap-pills", "/login/verify-account"]


def hosts(names: list[str]) -> list[str]:
    return [f"{PREFIXES[k % 4]}{name}.{ENDINGS[k // 4 % 4]}" for k, name in enumerate(names)]


def labelled(spark: SparkSession) -> DataFrame:
    """``url, label``: 1 for urls to block. A table of 388 rows, so training is bounded."""
    pairs = [(h, p, 0) for h in hosts(ORDINARY) for p in ORDINARY_PATHS]
    pairs += [(h, p, 1) for h in hosts(BAD) for p in ORDINARY_PATHS]
    pairs += [(h, BAD_PATHS[k % 5], 1) for k, h in enumerate(hosts(ORDINARY))]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('https://{h}{p}', {label}D)" for h, p, label in pairs) + " AS t(url, label)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_index(host: Column, path: Column, rules: tuple[Rule, ...]) -> list[tuple[Column, Rule]]:
    """Conditions in the order in which rules win."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name))
    return [(((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path), r) for r in ranked]


def gram_numbers() -> Column:
    """Distinct hashed n-grams of ``__host`` and ``__path``, marked by where they come from."""
    parts = []
    for mark, column in (("h", "__host"), ("p", "__path")):
        for n in GRAMS:
            text = f"concat('^', {column}, '$')"
            gram = f"concat('{mark}', substring({text}, i, {n}))"
            parts.append(
                f"if(length({text}) < {n}, array(), transform(sequence(1, length({text}) - {n - 1}),"
                f" i -> cast(pmod(xxhash64({gram}), {FEATURES}) AS int)))"
            )
    return F.expr(f"array_distinct(concat({', '.join(parts)}))")


@dataclass(frozen=True)
class UrlModel:
    """Weight of each hashed n-gram for blocking, and the intercept."""

    weights: tuple[float, ...]
    intercept: float

    def score(self, grams: str) -> Column:
        """Probability of blocking; the weights are a constant of the plan."""
        weights = "from_json('[" + ",".join(f"{w:.9g}" for w in self.weights) + "]', 'array<double>')"
        return F.expr(f"1 / (1 + exp(-aggregate({grams}, {self.intercept!r}D, (s, g) -> s + element_at({weights}, g + 1))))")


def trained(spark: SparkSession, labels: DataFrame | None = None) -> UrlModel:
    """The regression on ``labels (url, label)``, 1 for urls to block."""
    labels = labels if labels is not None else labelled(spark)
    host, path = host_and_path(F.col("url"))
    rows = labels.withColumn("__host", host).withColumn("__path", path).withColumn("__grams", gram_numbers())
    # A gram that no labelled url has gets no weight; the others are as many as a small table holds.
    grams = sorted(r.g for r in rows.select(F.explode("__grams").alias("g")).distinct().collect())
    known = F.array(*map(F.lit, grams))
    dense = F.transform(known, lambda g: F.array_contains(F.col("__grams"), g).cast("double"))
    fitted = LogisticRegression(regParam=0.01, maxIter=50).fit(rows.select(array_to_vector(dense).alias("features"), "label"))
    weights = [0.0] * FEATURES
    for g, w in zip(grams, fitted.coefficients):
        weights[g] = float(w)
    return UrlModel(tuple(weights), float(fitted.intercept))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, fitted: UrlModel | None = None) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` and the regression's ``score`` for blocking."""
    fitted = fitted or trained(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    pages = pages.drop("host", "path", "rule", "verdict", "score")
    scored = pages.withColumn("__host", host).withColumn("__path", path).withColumn("__grams", gram_numbers())
    scored = scored.withColumn("score", fitted.score("__grams"))
    rule = decided = None
    for fits, r in rule_index(F.col("__host"), F.col("__path"), rules):
        rule = F.when(fits, r.name) if rule is None else rule.when(fits, r.name)
        decided = F.when(fits, r.verdict) if decided is None else decided.when(fits, r.verdict)
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        *pages.columns,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        (rule if rule is not None else F.lit(None).cast("string")).alias("rule"),
        (decided.otherwise(learned) if decided is not None else learned).alias("verdict"),
        "score",
    )
