"""Url filter: rules first, then a logistic regression on hashed character n-grams (operator 2, DataFrame functions only).

The n-grams of host and path fall into ``DIMENSIONS`` buckets. Training is full-batch gradient descent as a DataFrame
aggregation: every step sums the gradient per bucket, and only that sum (``DIMENSIONS`` numbers) reaches the driver.
The labelled table is small by contract: at most ``MAX_LABELLED`` rows of each class are used, those with the smallest
hash. Weights travel as one literal of that fixed length.

Defined cases: a null url, or one without ``://``, has an empty host and path and is judged by the model's bias; ties
between rules of one length go to the greater rule text; repeated rows are judged alike; with no labelled row of one
class nothing can be learnt: every url without a rule is allowed; rows without label are not learnt; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.llm.base import ascii_lower, saved

DIMENSIONS, GRAMS = 4096, (3, 4, 5)
MAX_LABELLED = 1000
STEPS, RATE, MOMENTUM, DECAY = 16, 6.0, 0.85, 1e-4


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, "(?s)://([^/?#]*)([^?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)://([^/?#]*)([^?#]*)", 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """A struct (length, text, action) of the longest rule that fits, or null. The list is a literal: some hundred rules."""
    fits = [
        F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)), F.struct(F.lit(len(r.text)).alias("length"), F.lit(r.text).alias("text"), F.lit(r.action).alias("action")))
        for r in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,text:string,action:string>")


def with_buckets(df: DataFrame) -> DataFrame:
    """Adds __buckets to a frame with ``host`` and ``path``."""
    chars = F.filter(F.split(F.concat(F.lit("^"), F.col("host"), F.col("path"), F.lit("$")), ""), lambda c: c != "")
    df = df.withColumn("__chars", chars)
    last = F.size("__chars")
    grams = [
        F.when(last >= n, F.transform(F.sequence(F.lit(1), last - n + 1), lambda i: F.pmod(F.xxhash64(F.slice("__chars", i, n)), F.lit(DIMENSIONS)).cast("int"))).otherwise(F.array().cast("array<int>"))
        for n in GRAMS
    ]
    return df.withColumn("__buckets", F.flatten(F.array(*grams))).drop("__chars")


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    bias: float

    def margin(self) -> Column:
        """Over __buckets; above zero the url is unwanted."""
        table = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        total = F.aggregate("__buckets", F.lit(0.0), lambda a, i: a + F.get(table, i))
        return total / F.sqrt(F.greatest(F.size("__buckets"), F.lit(1))) + F.lit(self.bias)


def bounded(labelled: DataFrame) -> DataFrame:
    """At most ``MAX_LABELLED`` rows of each class, those with the smallest hash."""
    def chosen(label: int) -> DataFrame:
        of_class = labelled.where(F.col("label") == label).select("host", "path", "label").distinct()
        return of_class.orderBy(F.xxhash64("host", "path"), "host", "path").limit(MAX_LABELLED)

    return chosen(0).unionByName(chosen(1))


def train(labelled: DataFrame, steps: int = STEPS) -> Model:
    """``labelled``: host, path, and label 1 for unwanted urls, else 0. Classes count alike, whatever their sizes."""
    rows = saved(with_buckets(bounded(labelled)).coalesce(4), "url-labelled")
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows
    if not size.get(0) or not size.get(1):
        return Model((0.0,) * DIMENSIONS, -1.0)
    share = F.when(F.col("label") == 1, 0.5 / size[1]).otherwise(0.5 / size[0])
    weights, bias = [0.0] * DIMENSIONS, 0.0
    speed, bias_speed = [0.0] * DIMENSIONS, 0.0
    for _ in range(steps):
        miss = (1 / (1 + F.exp(-Model(tuple(weights), bias).margin())) - F.col("label")) * share
        pulled = rows.withColumn("miss", miss).select(
            F.explode(F.concat(F.array(F.lit(-1)), "__buckets")).alias("bucket"),
            "miss", (F.col("miss") / F.sqrt(F.greatest(F.size("__buckets"), F.lit(1)))).alias("scaled"),
        ).groupBy("bucket").agg(F.sum(F.when(F.col("bucket") < 0, F.col("miss")).otherwise(F.col("scaled"))).alias("g"))
        gradient = {r["bucket"]: r["g"] for r in pulled.collect()}  # DIMENSIONS + 1 rows at most
        bias_speed = MOMENTUM * bias_speed - RATE * 0.1 * gradient[-1]
        bias += bias_speed
        for i in range(DIMENSIONS):
            speed[i] = MOMENTUM * speed[i] - RATE * (gradient.get(i, 0.0) + DECAY * weights[i])
            weights[i] += speed[i]
    return Model(tuple(round(w, 9) for w in weights), round(bias, 9))


def judged(pages: DataFrame, rules: Sequence[Rule], model: Model) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict and probability (of being unwanted)."""
    at = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    at = with_buckets(at).withColumns({"chosen": longest_rule(F.col("host"), F.col("path"), rules), "margin": model.margin()})
    guess = F.when(F.col("margin") > 0, "block").otherwise("allow")
    return at.select(
        "page_id", "host", "path", F.col("chosen.text").alias("rule"), F.coalesce("chosen.action", guess).alias("verdict"), (1 / (1 + F.exp(-F.col("margin")))).alias("probability")
    )

