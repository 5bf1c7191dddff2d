"""URL filter: rules for hosts and paths, and a character language-model ratio for the rest.

The URLs that a rule decides are the labelled data. Two variable-order Markov models, one of
accepted and one of rejected URLs, give the probability of each character after up to
``ORDER`` characters before it; an order's estimate is smoothed with the next lower one in
proportion to the number of different characters seen there (Witten-Bell). A URL without a rule
is judged by the difference of its two log-likelihoods per character. The threshold is
calibrated on labelled URLs that the models have not seen: the value with the best mean of the
two classes' accuracies.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 5
#: Different labelled URLs of each class that the models and the threshold are fitted on: those
#: with the least hashes, of which one in ``HELD`` calibrates.
SAMPLE, HELD = 10_000, 5
ALPHABET = 256

Rule = tuple[str, str]  # "allow" or "block", and host/path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host without upper-case A-Z, and path; both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"
    has = text.contains("://")
    upper = "".join(map(chr, range(65, 91)))
    return (
        F.when(has, F.translate(F.regexp_extract(text, pattern, 1), upper, upper.lower()))
        .otherwise(""),
        F.when(has, F.regexp_extract(text, pattern, 2)).otherwise(""),
    )


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a domain above it, or nulls."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)) if rule is None else F.when(fits, F.lit(text)).otherwise(rule)
        verdict = (F.when(fits, F.lit(kind)) if verdict is None
                   else F.when(fits, F.lit(kind)).otherwise(verdict))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


class MarkovModel:
    """Character counts after contexts of 0 to ``order`` characters."""

    def __init__(self, texts: list[bytes], order: int = ORDER):
        self.order, self.after = order, {}
        for text in texts:
            line = text + b"\n"
            for at, symbol in enumerate(line):
                for size in range(min(order, at) + 1):
                    seen = self.after.setdefault(line[at - size:at], {})
                    seen[symbol] = seen.get(symbol, 0) + 1
        self.total = {context: sum(seen.values()) for context, seen in self.after.items()}

    def rate(self, text: bytes) -> float:
        """Log-likelihood per character, the end included."""
        line, out = text + b"\n", 0.0
        for at, symbol in enumerate(line):
            p = 1 / ALPHABET
            for size in range(min(self.order, at) + 1):
                context = line[at - size:at]
                seen = self.after.get(context)
                if seen is None:
                    break
                kinds = len(seen)
                p = (seen.get(symbol, 0) + kinds * p) / (self.total[context] + kinds)
            out += math.log(p)
        return out / len(line)


def seen_part(url: str | None) -> bytes:
    """What the models read: the URL behind its scheme."""
    return (url or "").partition("://")[2].encode() if "://" in (url or "") else (url or "").encode()


def best_threshold(accepted: list[float], rejected: list[float]) -> float:
    """Halfway between two scores, where the mean accuracy of both classes is best."""
    scores = sorted([(s, 1) for s in accepted] + [(s, 0) for s in rejected])
    right, best, cut = len(accepted) / max(1, len(accepted)), -1.0, 0.0
    lost = kept = 0
    for at, (score, good) in enumerate(scores):
        mean = right - lost / max(1, len(accepted)) + kept / max(1, len(rejected))
        if mean > best + 1e-12:
            best = mean
            cut = score if at == 0 else (scores[at - 1][0] + score) / 2
        lost, kept = lost + good, kept + 1 - good
    return cut


class RatioFilter:
    """Both models and their threshold, fitted on labelled URLs."""

    def __init__(self, accepted: list[str], rejected: list[str], order: int = ORDER):
        both = [sorted(map(seen_part, x)) for x in (accepted, rejected)]
        held = [x[::HELD] if len(x) >= HELD else x for x in both]
        learnt = [[u for i, u in enumerate(x) if i % HELD] if len(x) >= HELD else x for x in both]
        self.accepted, self.rejected = (MarkovModel(x, order) for x in learnt)
        self.known = bool(accepted), bool(rejected)
        self.cut = 0.0
        if all(self.known):
            self.cut = best_threshold(*[[self.ratio(u) for u in x] for x in held])

    def ratio(self, text: bytes) -> float:
        return self.accepted.rate(text) - self.rejected.rate(text)

    def allows(self, url: str | None) -> tuple[float, bool]:
        """(ratio above the threshold, whether to accept). With one class, that class."""
        if not all(self.known):
            return 0.0, not self.known[1]
        above = self.ratio(seen_part(url)) - self.cut
        return above, above >= 0


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", sample: int = SAMPLE) -> DataFrame:
    """``pages`` with host, path, rule, verdict and margin.

    A verdict is the longest fitting rule's, else the models'. ``margin`` is the log-likelihood
    difference per character above the threshold, null where a rule decides. Null and empty
    URLs have no rule and are judged as empty texts. If no URL is rejected by a rule, all
    others are accepted; if none is accepted, all are rejected. Columns of these names are
    replaced.
    """
    host, path = host_and_path(F.col(url_col))
    marked = pages.withColumns({"host": host, "path": path})
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    marked = marked.withColumns({"rule": rule, "verdict": verdict})
    labelled = marked.filter("rule is not null").select("verdict", F.col(url_col).alias("url"))
    chosen = {
        kind: [row[0] for row in labelled.filter(F.col("verdict") == kind).select("url").distinct()
               .orderBy(F.xxhash64("url"), "url").limit(sample).collect()]
        for kind in ("allow", "block")
    }
    fitted = pages.sparkSession.sparkContext.broadcast(RatioFilter(chosen["allow"], chosen["block"]))

    @F.arrow_udf("struct<margin:double,allow:boolean>")
    def ratio(column: pa.Array) -> pa.Array:
        found = [fitted.value.allows(u) for u in column.to_pylist()]
        return pa.array([{"margin": m, "allow": a} for m, a in found],
                        pa.struct([("margin", pa.float64()), ("allow", pa.bool_())]))

    own = "_ratio"
    while own in marked.columns:
        own += "_"
    free = F.col("rule").isNull()
    return marked.withColumn(own, ratio(F.col(url_col))).withColumns({
        "margin": F.when(free, F.col(f"{own}.margin")),
        "verdict": F.when(free, F.when(F.col(f"{own}.allow"), "allow").otherwise("block"))
        .otherwise(F.col("verdict")),
    }).drop(own)
