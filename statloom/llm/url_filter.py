"""URL filter: domain and path rules first, else logistic regression on hashed character n-grams.

The features of a URL are the character n-grams of its host (with ``^`` and ``$`` at its ends) and
of its path, hashed to a fixed number of indices; host and path have hashes of their own. The
weights come from a small labelled table and are therefore of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (host, path prefix, verdict). A rule fits its host and all of its subdomains.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

#: The labelled URLs; 1 is to be blocked.
LABELLED = (
    ("http://casino-win.example.com/en/1", 1),
    ("https://www.casino-royal.example.org/de/22.html", 1),
    ("http://online-casino.example.com/slots/play", 1),
    ("https://m.free-bets.example.com/en/410", 1),
    ("http://bets-now.example.org/es/55#top", 1),
    ("https://sports-bets.example.com/fr/9?page=2&ref=x", 1),
    ("http://www.cheap-pills.example.com/de/6652.html", 1),
    ("https://pills-online.example.org/en/71/", 1),
    ("http://cheap-meds.example.com/buy/now", 1),
    ("https://blog.xxx-videos.example.com/en/3", 1),
    ("http://adult-cams.example.org/fr/18", 1),
    ("https://porn-tube.example.com/es/7", 1),
    ("http://payday-loans.example.com/en/12", 1),
    ("https://fast-loans.example.org/de/4", 1),
    ("http://poker-bonus.example.com/es/99/", 1),
    ("https://lottery-prize.example.org/en/5", 1),
    ("http://replica-watches.example.com/fr/31", 1),
    ("https://win-money.example.com/en/64#top", 1),
    ("http://thering.example.org/en/1291/", 0),
    ("https://www.tionsh.example.com/fr/8424.html", 0),
    ("https://blog.ththst.example.com/en/1837/", 0),
    ("http://m.therhe.example.org/de/8423?utm_source=feed", 0),
    ("https://news.example.org/en/politics/2020", 0),
    ("http://library.example.com/catalogue/books", 0),
    ("https://docs.example.org/en/guide/index.html", 0),
    ("http://www.university.example.com/research/papers", 0),
    ("https://wiki.example.org/de/Geschichte", 0),
    ("http://museum.example.com/es/arte/obras", 0),
    ("https://journal.example.org/fr/sciences/12", 0),
    ("http://weather.example.com/en/forecast/77", 0),
    ("https://www.hospital.example.org/en/contact", 0),
    ("http://blog.gardening.example.com/en/tomatoes", 0),
    ("https://recipes.example.com/fr/soupe", 0),
    ("http://forum.example.org/es/temas?page=2&ref=x", 0),
    ("https://school.example.com/de/klassen/5#top", 0),
    ("http://ouan.example.com/es/4033", 0),
)

#: Number of feature indices, lengths of the n-grams, and the probability from which a URL is blocked.
SLOTS, NGRAMS, BLOCK_FROM = 1 << 18, (3, 4, 5), 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for NULL."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    found = F.locate("://", url)
    rest = F.when(found > 0, url.substr(found + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text (``net/``) and verdict of the longest rule that fits; NULL where none does."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, prefix, says in reversed(ordered):  # the longest is asked first
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(prefix)
        name = F.when(fits, F.lit(rule_host + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def url_features(host: str, path: str, slots: int = SLOTS, ngrams: tuple[int, ...] = NGRAMS) -> np.ndarray:
    """Distinct feature indices of one URL."""
    found = set()
    for kind, part in (("h", f"^{host}$"), ("p", path)):
        for n in ngrams:
            found.update(f"{kind}{part[i : i + n]}" for i in range(len(part) - n + 1))
    return np.array(sorted({xxhash.xxh64_intdigest(g) % slots for g in found}), np.int64)


def fit_logistic(
    rows: list[np.ndarray], labels: np.ndarray, slots: int = SLOTS, penalty: float = 1e-2, rounds: int = 300
) -> tuple[np.ndarray, float]:
    """Weights and intercept by gradient descent; a row's features share its unit length."""
    index = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    sizes = np.array([len(r) for r in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    value = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
    weights, intercept, step = np.zeros(slots), 0.0, 2.0
    for _ in range(rounds):
        margin = np.bincount(row, weights[index] * value, minlength=len(rows)) + intercept
        wrong = 1 / (1 + np.exp(-margin)) - labels
        slope = np.bincount(index, wrong[row] * value, minlength=slots) / max(len(rows), 1)
        weights -= step * (slope + penalty * weights / max(len(rows), 1))
        intercept -= step * wrong.mean() if len(rows) else 0.0
    return weights, float(intercept)


def _split(url: str) -> tuple[str, str]:
    rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
    host, slash, path = rest.partition("/")
    return host.lower(), slash + path


def url_filter(
    pages: DataFrame, url: str = "url", rules=RULES, labelled=LABELLED, block_from: float = BLOCK_FROM
) -> DataFrame:
    """Input columns with ``host, path, rule, block_probability, verdict`` (allow or block).

    A NULL URL or one without ``://`` has an empty host and path; the model judges it (without
    features, by its intercept). Input columns that bear an added name are replaced. Equal URLs get
    equal verdicts; an empty table gives an empty result.
    """
    urls, labels = [_split(u) for u, _ in labelled], np.array([y for _, y in labelled], float)
    weights, intercept = fit_logistic([url_features(*u) for u in urls], labels)
    used = np.flatnonzero(weights)
    model = pages.sparkSession.sparkContext.broadcast((used, weights[used]))  # of the labelled URLs

    @F.pandas_udf("double")
    def probability(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        dense = np.zeros(SLOTS)
        dense[model.value[0]] = model.value[1]
        for hosts, paths in parts:
            margins = np.full(len(hosts), intercept)
            for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
                own = url_features(h, p)
                if len(own):
                    margins[i] += dense[own].sum() / np.sqrt(len(own))
            yield pd.Series(1 / (1 + np.exp(-margins)))

    added = ("host", "path", "rule", "block_probability", "verdict")
    host, path = split_url(F.col(url))
    kept = [c for c in pages.columns if c.lower() not in added]
    parted = pages.select(*kept, host.alias("host"), path.alias("path"))
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    scored = parted.withColumn("rule", name).withColumn("block_probability", probability("host", "path"))
    judged = F.when(F.col("block_probability") >= block_from, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce(verdict, judged))
