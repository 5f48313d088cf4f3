"""URL filter: rules first, else a logistic regression on hashed character n-grams.

Method. The host and path of a URL are cut into character n-grams, hashed into ``BUCKETS``
features (host and path apart). A logistic regression is trained from a small labelled URL
table (a parameter; the default is ``LABELLED``) by gradient descent in numpy, on the
driver; the weights go with the tasks. Rules ``host/path`` decide before the model: a rule
fits its host and all subdomains if the URL's path starts with the rule's; the longest wins.

Scale. One map over the URL column; the model and the rules are bounded parameters.

Edge cases: null, and text without ``://``, have an empty host and path, no rule, and the
model's verdict on nothing (its constant: allow); repeated rows give repeated results;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import text_input

BUCKETS, SHORTEST, LONGEST = 1 << 14, 3, 5
#: The rules of the contract.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: The default labelled table: (url, is it to be blocked).
LABELLED = [
    ("https://www.cheap-pills.example/buy/now", True), ("http://cheap-meds.example/pills/discount", True), ("http://pharma-pills.example/order", True),
    ("https://m.free-bets.example/bonus", True), ("http://best-bets.example/casino/free", True), ("http://casino-spins.example/slots/win", True),
    ("http://m.adult-x.example/video", True), ("https://adult-cams.example/live", True), ("http://xxx-tube.example/clips", True),
    ("https://ads-track.example/click", True), ("http://track-ads.example/pixel/redirect", True), ("http://adserver.example/banner/track", True),
    ("http://free-prize.example/winner/claim", True), ("http://loans-fast.example/cash/apply", True), ("http://replica-watches.example/cheap", True),
    ("http://spam-links.example/farm/page", True), ("https://online-casino.example/win/jackpot", True), ("http://casino-bonus.example/win", True),
    ("https://www.daily-news.example/en/politics/12", False), ("http://blog.gardening.example/posts/roses", False), ("https://docs.python-lib.example/reference/index.html", False),
    ("https://university.example/de/research/physics", False), ("http://www.city-library.example/fr/catalogue", False), ("https://recipes.example/es/soup/44", False),
    ("https://museum.example/en/exhibitions", False), ("http://m.weather.example/en/forecast/7.html", False), ("https://blog.travels.example/en/78", False),
    ("https://the-history.example/de/20", False), ("http://therapy.example/en/519", False), ("https://www.theatre.example/fr/964", False),
    ("https://forum.example/threads/825?page=2", False), ("http://science.example/es/332", False), ("https://encyclopedia.example/en/article/earth", False),
    ("http://blog.thinking.example/fr/65.html", False), ("https://www.nation.example/de/839", False),
]
_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lowered) and path."""
    found = _URL.search(url or "")
    return (found[1].encode().lower().decode(), found[2]) if found else ("", "")


def grams(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams; ``^`` and ``$`` mark the ends."""
    out = set()
    for mark, text in ((b"h", host), (b"p", path)):
        if text:
            raw = b"^" + text.encode() + b"$"
            out.update(zlib.crc32(mark + raw[i : i + n]) % BUCKETS for n in range(SHORTEST, LONGEST + 1) for i in range(len(raw) - n + 1))
    return np.fromiter(out, np.int64, len(out))


def train(labelled: list[tuple[str, bool]] = LABELLED, steps: int = 400, rate: float = 2.0, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and constant; each URL's features have unit length."""
    x = np.zeros((len(labelled), BUCKETS))
    for row, (url, _) in zip(x, labelled, strict=True):
        at = grams(*split_url(url))
        row[at] = 1 / np.sqrt(max(1, len(at)))
    y = np.array([b for _, b in labelled], float)
    weight, constant = np.zeros(BUCKETS), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))) if len(y) else -1.0
    for _ in range(steps if len(y) else 0):
        error = y - 1 / (1 + np.exp(-(x @ weight + constant)))
        weight += rate * (x.T @ error - ridge * weight)
        constant += 0.1 * rate * error.mean()
    return weight, constant


class Rules:
    """Rules by host; a host's own suffixes find those that fit."""

    def __init__(self, rules: dict[str, str]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules.items():
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple[str | None, str | None] = (None, None)
        parts = host.split(".")
        for i in range(len(parts)):
            for prefix, rule, verdict in self.by_host.get(".".join(parts[i:]), ()):
                if path.startswith(prefix) and (best[0] is None or len(rule) > len(best[0])):
                    best = (rule, verdict)
        return best


def _judge(rules: dict[str, str], weight: np.ndarray, constant: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Rules(rules)
        for batch in batches:
            hosts, paths, fits, verdicts, scores = [], [], [], [], []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                rule, verdict = own.match(host, path)
                at = grams(host, path)
                score = 1 / (1 + np.exp(-(weight[at].sum() / np.sqrt(max(1, len(at))) + constant)))
                if not len(at):
                    score = min(score, 0.5)
                hosts.append(host)
                paths.append(path)
                fits.append(rule)
                verdicts.append(verdict or ("block" if score > 0.5 else "allow"))
                scores.append(float(score))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(fits, pa.string()), pa.array(verdicts, pa.string()), pa.array(scores, pa.float64())],
                names=["page_id", "host", "path", "rule", "verdict", "score"],
            )

    return run


def judge_urls(pages: DataFrame, rules: dict[str, str] = RULES, labelled: list[tuple[str, bool]] = LABELLED, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, score`` (the model's
    probability that the URL is to be blocked)."""
    kind = pages.schema[id_column].dataType.simpleString()
    source = text_input(pages, F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"))
    return source.mapInArrow(_judge(rules, *train(labelled)), f"page_id {kind}, host string, path string, rule string, verdict string, score double")
