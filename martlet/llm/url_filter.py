"""URL filter: host and path rules, and a logistic regression for the rest.

DataFrame functions only. A URL's host and path are cut into character
n-grams (3 to 5, marked by the part they come from) hashed into ``BUCKETS``
features. The regression is trained on a small labelled URL table with a
fixed number of full-batch gradient steps (Nesterov momentum): each step is
one distributed aggregate that returns one row per feature, so what reaches
the driver is bounded by ``BUCKETS`` whatever the table's size. Scoring adds
up weights inside the row; nothing is shuffled.

Defined cases: a null URL or one without ``://`` has empty host and path, no
n-grams and no rule, and gets the verdict of the regression's intercept; a
labelled table without rows of both kinds gives a constant regression (the
kind it has, ``allow`` if none); repeated rows are judged alike; an empty
table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import Stage, first_by_hash

BUCKETS = 4096
GRAMS = (3, 4, 5)
STEPS = 25
L2 = 1e-4
# Rows of each kind in a labelled table that is drawn from rules.
LABELLED_ROWS = 1000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL, both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(authority, _UPPER, _UPPER.lower())
    path = F.regexp_extract(F.substr(rest, F.length(authority) + F.lit(1)), r"^[^?#]*", 0)
    return host, path


def matched_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule name, its verdict) of the longest rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) \
            & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _hashed_grams(part: Column, mark: str, n: int) -> Column:
    starts = F.when(F.length(part) >= n, F.sequence(F.lit(0), F.length(part) - F.lit(n))).otherwise(
        F.array().cast("array<int>"))
    # the characters are bound to a variable of their own: inside the inner lambda an
    # expression would be evaluated again for every n-gram
    return F.flatten(F.transform(F.array(F.split(part, "")), lambda chars: F.transform(
        starts, lambda i: F.pmod(
            F.xxhash64(F.lit(mark), *[F.get(chars, i + F.lit(k)) for k in range(n)]),
            F.lit(BUCKETS)).cast("int"))))


def features(host: Column, path: Column) -> Column:
    """The distinct hashed n-grams of host (with its ends marked) and path."""
    framed = F.when(host == "", host).otherwise(F.concat(F.lit("^"), host, F.lit("$")))
    return F.array_distinct(F.concat(
        *[_hashed_grams(framed, "h", n) for n in GRAMS],
        *[_hashed_grams(path, "p", n) for n in GRAMS]))


@dataclass
class Model:
    weights: list[float]
    intercept: float

    def score(self, grams: Column) -> Column:
        """Probability of ``block``."""
        # one literal text, folded once by the optimizer, instead of BUCKETS literals; the
        # intercept rides along, so that every training step compiles to the same code
        packed = ",".join(map(repr, [*self.weights, self.intercept]))
        weights = F.split(F.lit(packed), ",").cast("array<double>")
        z = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(weights, g))
        z = z / F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double")) + F.get(weights, F.lit(BUCKETS))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def train(labelled: DataFrame) -> Model:
    """Fit on (url, block): ``block`` 1 or 0; a small table, staged once."""
    host, path = parse(F.col("url"))
    stage = Stage(labelled.sparkSession, "url-filter")
    data = stage.write(labelled.where(F.col("block").isNotNull()).select(
        features(host, path).alias("grams"), F.col("block").cast("double").alias("y")), "labelled")
    rows, ones = data.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    zero = [0.0] * BUCKETS
    if not rows or ones in (0, rows):
        return Model(zero, 5.0 if rows and ones else -5.0)
    weights, base = zero, math.log(ones / (rows - ones))
    ahead, ahead_base, t = list(weights), base, 1.0
    for _ in range(STEPS):
        error = (Model(ahead, ahead_base).score(F.col("grams")) - F.col("y"))
        each = data.select(error.alias("e"), F.col("grams"), (
            error / F.sqrt(F.greatest(F.size("grams"), F.lit(1)).cast("double"))).alias("s"))
        # the intercept's gradient travels as feature -1
        slopes = each.select(F.explode(F.concat(
            F.array(F.struct(F.lit(-1).alias("g"), F.col("e").alias("v"))),
            F.transform("grams", lambda g: F.struct(g.alias("g"), F.col("s").alias("v"))),
        )).alias("x")).groupBy("x.g").agg(F.sum("x.v").alias("v")).collect()
        step = 4.0 / rows  # the curvature of the mean loss is at most 1/4 on unit rows
        new, new_base = [a * (1.0 - 4.0 * L2) for a in ahead], ahead_base
        for g, v in slopes:
            if g < 0:
                new_base -= 0.5 * step * v
            else:
                new[g] -= 0.5 * step * v
        t_next = (1.0 + math.sqrt(1.0 + 4.0 * t * t)) / 2.0
        push = (t - 1.0) / t_next
        ahead = [n + push * (n - w) for n, w in zip(new, weights)]
        ahead_base = new_base + push * (new_base - base)
        weights, base, t = new, new_base, t_next
    stage.release(data)
    return Model(weights, base)


def labelled_from_rules(pages: DataFrame, rules: list[Rule], url_col: str = "url",
                        rows: int = LABELLED_ROWS) -> DataFrame:
    """A small labelled URL table: of the distinct URLs that the rules decide,
    the ``rows`` first of each kind in the order of their hash."""
    host, path = parse(F.col(url_col))
    _, verdict = matched_rule(rules, host, path)
    decided = pages.select(F.col(url_col).alias("url"), verdict.alias("verdict")).where(
        "verdict IS NOT NULL")
    counts = {r["verdict"]: r["n"] for r in decided.groupBy("verdict").agg(
        F.approx_count_distinct("url").alias("n")).collect()}

    def kind(name: str) -> DataFrame:
        # the estimate is within a few percent, which the threshold's margin covers
        urls = decided.where(F.col("verdict") == name).select("url").distinct()
        return first_by_hash(urls, "url", rows, int(0.8 * counts.get(name, 0))).select(
            "url", F.lit(int(name == "block")).alias("block"))

    return kind("allow").unionByName(kind("block"))


def url_filter(pages: DataFrame, rules: list[Rule], model: Model, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and the regression's block_score."""
    host, path = parse(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    name, verdict = matched_rule(rules, F.col("host"), F.col("path"))
    scored = parsed.select(
        "page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"),
        model.score(features(F.col("host"), F.col("path"))).alias("block_score"))
    learned = F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", learned).alias("verdict"), "block_score")
