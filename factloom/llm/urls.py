"""URL filters: host and path rules first, a logistic regression on hashed n-grams for the rest.

The regression is fitted on the driver from a small labelled table of URLs (a parameter, ``LABELLED``
by default, whose names a list and shapes make) and sent to the tasks as one weight vector of fixed size.

Defined cases: a url that is null or has no ``://`` has an empty host and path, no rule, and no features,
which allows it; of several rules that fit with equal lengths the last by text wins; a probability of one
half allows; repeated rows are judged row by row; a very long url is judged on all its n-grams; null page
ids stay null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path prefix, verdict); a rule fits its host and all subdomains.
RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)
DIMENSIONS = 1 << 18
#: Weight of half the squared weights against the log likelihood.
PENALTY = 0.05
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Names of the labelled table, written for it and taken from no corpus.
UNWANTED = (
    "poker blackjack roulette jackpot slots slotmachines betting sportsbet wagering bookmaker lottery bingo "
    "porn xxx sex sexcams escorts nudes hentai camgirls erotic milf fetish "
    "viagra cialis pharmacy-discount steroids dietpills weightloss-miracle meds-noprescription "
    "warez keygen serialcrack torrentz pirated cracked-software nulled "
    "phishing malware ransomware trojan exploit-kit stealer botnet "
    "paydayloan quickloan fastcash getrich bitcoin-doubler forex-signals replica-watches fake-rolex "
    "popunder adserver adclick clickbait trafficbot linkexchange seo-backlinks buyfollowers"
).split()
HARMLESS = (
    "library garden school museum kitchen weather science history travel recipes music forest harbour river "
    "market journal atlas letters bridge village physics poetry nation station theatre times open-data "
    "city-news old-maps book-review daily-news art-school sea-life home-garden university college hospital "
    "clinic church council parliament railway airport bakery restaurant coffee brewery vineyard farmers "
    "cycling hiking running swimming football tennis athletics chess puzzle photography painting sculpture "
    "orchestra jazz opera cinema drama dance novel dictionary grammar language translation mathematics "
    "algebra geometry biology chemistry botany zoology geology astronomy telescope observatory climate ocean "
    "mountain valley island desert lake coast wildlife birds horses gardening knitting sewing carpentry "
    "pottery furniture lighting plumbing engineering software hardware database compiler kernel wiki forum "
    "blog archive gazette courier herald tribune magazine radio television podcast essex-county sussex "
    "alphabet betty crackers analytics exploration doubles replication wagon pharmacology sextant"
).split()
BEFORE = "best my the all buy hot new pro top go".split()
AFTER = "site online shop store hub zone world list room now 24 s".split()
HOSTS = ("{}.com", "www.{}.org", "{}.net", "{}.info", "{}.example.com", "{}.example.net", "{}.example.org", "blog.{}.co", "{}.io", "m.{}.de", "{}.biz")
PATHS = ("/", "/index.html", "/en/12", "/de/405.html", "/fr/77/", "/es/9?page=2", "/news/2024/05", "/about", "/watch/311#top", "/{}", "/{}/page", "/home")
WORDLESS = "ra to mi ne lo vi sa ku be do".split()


def labelled() -> list[tuple[str, int]]:
    """The labelled table, (url, unwanted): every name alone, after and before another word, on hosts and
    paths taken in turn, and made-up names without meaning, which are harmless."""
    names = [(n, 1) for n in UNWANTED] + [(n, 0) for n in HARMLESS]
    names += [("".join(x), 0) for x in itertools.product(WORDLESS, WORDLESS[::2], WORDLESS[::3])]
    hosts, paths, before, after = map(itertools.cycle, (HOSTS, PATHS, BEFORE, AFTER))
    forms = [(form, y, n) for n, y in names for form in (n, next(before) + n, n + next(after), next(before) + n + next(after))]
    return [(f"https://{next(hosts).format(form)}{next(paths).format(n)}", y) for form, y, n in forms]


LABELLED = tuple(labelled())


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def split_url(url: str | None) -> tuple[str, str]:
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(str.maketrans(UPPER, LOWER)), m[2]) if m else ("", "")


def rule_text(host: str, path: str) -> str:
    return f"{host}{path}"


def rule_fits(rules, host: Column, path: Column) -> Column:
    """The index of the longest rule that fits, ties by text; null if none does."""
    out = F.lit(None).cast("int")
    for i in sorted(range(len(rules)), key=lambda i: (len(rule_text(*rules[i][:2])), rule_text(*rules[i][:2]))):
        h, p, _ = rules[i]
        out = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(i)).otherwise(out)
    return out


def features(host: str, path: str) -> set[int]:
    """Hashed character n-grams of 3 to 5, of host and path apart."""
    out = set()
    for kind, part in ((b"h", host), (b"p", path)):
        s = f"^{part}$".encode() if part else b""
        for n in (3, 4, 5):
            out.update(zlib.crc32(kind + s[i : i + n]) % DIMENSIONS for i in range(len(s) - n + 1))
    return out


def fit(table: tuple[tuple[str, int], ...] = LABELLED, rounds: int = 3000, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias of the largest likelihood with an L2 penalty on the weights, by accelerated gradient
    descent over the features that the table has; a row's features weigh one over the root of their number."""
    rows = [np.array(sorted(features(*split_url(u))), np.int64) for u, _ in table]
    y, sizes = np.array([v for _, v in table], float), np.array([len(r) for r in rows])
    known, at = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_inverse=True)
    who, norm = np.repeat(np.arange(len(rows)), sizes), 1 / np.sqrt(np.maximum(1, sizes))
    out = np.zeros(DIMENSIONS, np.float32)
    if not len(set(y.tolist())) > 1:
        return out, 0.0
    w, bias = np.zeros(len(known)), 0.0
    ahead, ahead_bias, turn = w, bias, 1.0
    rate = 4 / (2 * len(rows))  # rows have unit length and a bias: the curvature is at most half their number
    for _ in range(rounds):
        z = norm * np.bincount(who, ahead[at], len(rows)) + ahead_bias
        off = 1 / (1 + np.exp(-z)) - y
        new = ahead - rate * (np.bincount(at, (off * norm)[who], len(known)) + penalty * ahead)
        new_bias, next_turn = ahead_bias - rate * off.sum(), (1 + (1 + 4 * turn * turn) ** 0.5) / 2
        ahead, ahead_bias = new + (turn - 1) / next_turn * (new - w), new_bias + (turn - 1) / next_turn * (new_bias - bias)
        w, bias, turn = new, new_bias, next_turn
    out[known] = w
    return out, float(bias)


def judge_urls(pages: DataFrame, rules=RULES, table=LABELLED) -> DataFrame:
    """page_id, host, path, rule, verdict and the regression's probability that the url is unwanted."""
    weights, bias = fit(table)
    model = pages.sparkSession.sparkContext.broadcast(weights)  # DIMENSIONS numbers, whatever the input

    def score(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, known = model.value, {}
        for b in found:
            out = []
            for host, path in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if (host, path) not in known:
                    f = np.fromiter(features(host, path), np.int64)
                    z = bias + float(w[f].sum(dtype=np.float64)) / max(1, len(f)) ** 0.5 if len(f) else -1.0
                    if len(known) > 50_000:
                        known.clear()
                    known[host, path] = float(1 / (1 + np.exp(-z)))
                out.append(known[host, path])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], names=[*b.schema.names, "unwanted"])

    host, path = parts(F.col("url"))
    df = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = pages.schema["page_id"].dataType.simpleString()
    df = df.mapInArrow(score, f"page_id {kind}, host string, path string, unwanted double")
    df = df.withColumn("_rule", rule_fits(rules, F.col("host"), F.col("path")))
    names = F.array(*[F.lit(rule_text(*r[:2])) for r in rules]) if rules else F.array(F.lit(None).cast("string"))
    verdicts = F.array(*[F.lit(r[2]) for r in rules]) if rules else F.array(F.lit(None).cast("string"))
    by_model = F.when(F.col("unwanted") > 0.5, "block").otherwise("allow")
    return df.select(
        "page_id",
        "host",
        "path",
        F.get(names, F.col("_rule")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("_rule")), by_model).alias("verdict"),
        "unwanted",
    )
