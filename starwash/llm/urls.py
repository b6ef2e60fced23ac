"""URL filter: host and path rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starwash.llm.common import bounded_sample

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Verdict, host, path prefix.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

#: Words of hosts and paths that the labelled table is made of.
UNWANTED = (
    "ads adserver adult bets betting bingo bonus-win casino cheap-meds clickbait crack cracked dating-hot doubleclick "
    "escort fake-watches free-bets free-iphone gamble gambling get-rich hookup jackpot keygen lottery loan-fast lucky "
    "malware meds nude payday pills phishing pokies popads poker porn prize replica roulette sex slots spam spyware "
    "sweepstakes torrent-crack track tracker tracking traffic-exchange viagra warez webcam-girls win-big win xxx"
).split()
FILLERS = "cheap farm fast free hot now online x zone club best 24 365 top real".split()
WANTED = (
    "academy archive art astronomy bakery bank biology blog books botany bridge chemistry choir church city clinic "
    "college community cooking council data docs economy education energy farmer festival forest forum garden gazette "
    "geology guide harbour health help history hospital journal kitchen language law library local magazine maths "
    "medicine museum music nature news observatory open opera orchestra parks physics planet poetry post press "
    "project radio railway recipes research review river school science society software sports story studio teacher "
    "theatre times tools town travel trees union university valley village water weather wiki winery women work world"
).split()
SYLLABLES = (
    "an ar as at be ble ca ch ci co da de di do ed el en er es et ge ha he ho in ing io is it ke la le li lo ly ma me "
    "mo na ne nd no nt on or ou pa pe ra re ri ro sa se sh si so st ta te th ti tion to tra tu un ur us ve vi wa wh wi"
).split()
LABELLED_URLS = 4000

DIMENSIONS = 1 << 16
GRAM_LENGTHS = (3, 4, 5)
MAX_LABELLED = 4000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Path: from there to ``?``, ``#`` or the end. Both are empty for null and for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (host and path together) that fits, and its verdict; null where none fits.

    ``rules`` is a literal list, so it becomes one chain of conditions. Equally long rules: the first.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def gram_features(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed character n-grams of many urls: (row, dimension, weight), each row of unit weight overall.

    All urls lie in one code array; an n-gram that crosses into the next url is masked out.
    """
    joined = [f"\x02{h}\x03{p}\x04" for h, p in zip(hosts, paths)]
    lengths = np.array([len(s) for s in joined], dtype=np.int64)
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(joined)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters up to the url's end
    rows, dims = [], []
    for n in GRAM_LENGTHS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ codes[k : len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = left[: len(h)] >= n
        rows.append(row[: len(h)][inside])
        dims.append((h[inside] % np.uint64(DIMENSIONS)).astype(np.int64))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    r, d = np.concatenate(rows), np.concatenate(dims)
    weight = 1 / np.sqrt(np.maximum(1, np.bincount(r, minlength=len(joined))))
    return r, d, weight[r]


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float

    def blocked(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """Log-odds of ``block`` above zero."""
        r, d, w = gram_features(hosts, paths)
        return np.bincount(r, weights=self.weights[d] * w, minlength=len(hosts)) + self.bias > 0


def fit(hosts: Sequence[str], paths: Sequence[str], blocked: Sequence[bool], steps: int = 150) -> UrlModel:
    """Logistic regression by full-batch gradient steps with a small ridge; the same rows give the same model.

    Both classes weigh the same in total. With one class the model answers that class, without rows ``allow``.
    """
    y = np.asarray(blocked, dtype=float)
    if len(y) == 0 or y.min() == y.max():
        return UrlModel(np.zeros(DIMENSIONS), 1.0 if len(y) and y[0] else -1.0)
    r, d, w = gram_features(hosts, paths)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    weights, bias = np.zeros(DIMENSIONS), 0.0
    speed, speed_b = np.full(DIMENSIONS, 1e-12), 1e-12
    for _ in range(steps):
        z = np.bincount(r, weights=weights[d] * w, minlength=len(y)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * share
        slope = np.bincount(d, weights=error[r] * w, minlength=DIMENSIONS) + 1e-6 * weights
        slope_b = error.sum()
        speed += slope**2
        speed_b += slope_b**2
        weights -= 0.5 * slope / np.sqrt(speed)
        bias -= 0.1 * slope_b / np.sqrt(speed_b)
    return UrlModel(weights, float(bias))


def train(labelled: DataFrame, max_rows: int = MAX_LABELLED) -> UrlModel:
    """Fit on a labelled table (url, blocked boolean), at most ``max_rows`` distinct rows.

    That bound is what reaches the driver. Rows without a label are ignored, a null url counts as empty.
    """
    host, path = host_and_path(F.col("url"))
    known = labelled.filter(F.col("blocked").isNotNull()).select(host.alias("host"), path.alias("path"), "blocked")
    rows = bounded_sample(known, max_rows).collect()
    return fit([r.host for r in rows], [r.path for r in rows], [r.blocked for r in rows])


def judge_urls(
    pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``; the rule decides, else the model.

    Every input row gives one output row, repeated rows too; other columns, whatever their names, are left out. A null
    url and one without ``://`` have an empty host and path, fit no rule and are judged by the model's bias. A very
    long url is judged whole.
    """
    model = train(labelled)
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, decision = matching_rule(F.col("host"), F.col("path"), rules)

    @F.pandas_udf("boolean")
    def blocked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            yield pd.Series(model.blocked(hosts.tolist(), paths.tolist()), dtype=bool)

    by_model = F.when(blocked("host", "path"), "block").otherwise("allow")
    return parsed.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decision, by_model).alias("verdict")
    )


def labelled_urls(spark: SparkSession, rows: int = LABELLED_URLS, seed: int = 5) -> DataFrame:
    """(url, blocked): the small labelled table that the model learns from, made by a rule from two word lists.

    Hosts of both classes have the same subdomains, endings and paths, so only the words of host and path tell them
    apart: a blocked url has one or two words of UNWANTED in its host, at times one in its path, an allowed one words
    of WANTED or made-up names of syllables, and may have one harmless piece of an unwanted word inside a name.
    """
    rng = random.Random(seed)

    def name() -> str:
        made_up = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4)))
        return rng.choice([made_up, made_up, rng.choice(WANTED), rng.choice(WANTED) + rng.choice(["-", "", "-"]) + made_up])

    def unwanted() -> str:
        words = [rng.choice(UNWANTED), rng.choice([rng.choice(UNWANTED), rng.choice(FILLERS), name(), ""])]
        rng.shuffle(words)
        return rng.choice(["-", "", "-"]).join(w for w in words if w)

    out = []
    for i in range(rows):
        blocked = i % 2 == 0
        host = f"{rng.choice(['', '', 'www.', 'm.', 'blog.', 'shop.'])}{unwanted() if blocked else name()}"
        ending = rng.choice(["com", "org", "net", "info", "example.com", "example.org", "example.net"])
        words = [rng.choice(["en", "de", "fr", "es", "it", "post", "p", "a"])]
        words += [rng.choice(UNWANTED if blocked else WANTED)] * (rng.random() < 0.3)
        path = "/".join([*words, str(rng.randint(0, 9999))]) + rng.choice(["", "/", ".html", "?page=2", "#top"])
        out.append((f"{rng.choice(['http', 'https'])}://{host}.{ending}/{path}", blocked))
    return spark.createDataFrame(out, "url string, blocked boolean")


def labelled_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Urls a rule decides, as labelled rows for ``train``, for lists of rules that cover both classes everywhere."""
    _, decision = matching_rule(*host_and_path(F.col("url")), rules)
    return pages.select("url", (decision == "block").alias("blocked")).filter("blocked is not null")
