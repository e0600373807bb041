"""URL filter: rules for known hosts, a ratio of character models for the rest.

Where a rule fits, the longest one decides. The URLs decided so are the examples
that two character models are learnt from, one of accepted and one of rejected
URLs. A model predicts each character of host and path from those before it. It
has variable order: a context counts if it was seen, and each order is smoothed by the next shorter one, so that

    p(x | c) = (count(c x) + m * p(x | c without its first)) / (count(c) + m).

The logarithm of a URL's probability is then a sum over its substrings: one
figure for a substring as context and character and one for it as context of the
next character. The difference of both models by length is the score, and the
threshold on it is the one that separates held-out examples best.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.llm.rows import computed
from yearloom.scratch import settled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Put before and after each text; no URL holds them unescaped.
START, END = "\x02", "\x03"
_MICRO = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Settings:
    """``order`` is the longest context, ``mass`` the weight of the shorter one.

    A substring counts if at least ``min_share`` of all positions have it; at 0
    every one does. Up to ``most_sent`` weights are sent to every task. Of more,
    those of substrings that ``hot_share`` of the positions have are, which are
    at most ``1 / hot_share`` of each length, and the others joined by shuffle.
    ``alphabet`` is the number of characters an unseen one is one of. One in
    ``folds`` examples is held out to find the threshold, which is sought among
    multiples of ``step`` of at most ``limit`` either way.
    """

    order: int = 4
    mass: float = 2.0
    min_share: float = 0.0
    hot_share: float = 2e-5
    most_sent: int = 250_000
    alphabet: int = 256
    folds: int = 5
    step: float = 0.01
    limit: float = 10.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _first_fit(rules: Sequence[Rule], what) -> Column:
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        on_host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        chosen = F.when(on_host & F.col("path").startswith(rule.path), what(rule)).otherwise(chosen)
    return chosen


def _substrings(table: DataFrame, longest: int) -> DataFrame:
    """The columns beside ``text``, and ``s`` for each substring up to ``longest``."""
    n = F.length("text")

    def of(k: int) -> Column:
        starts = F.when(n >= k, F.sequence(F.lit(1), n - k + 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda i: F.substr(F.col("text"), i, F.lit(k)))

    return table.withColumn("s", F.explode(F.concat(*[of(k) for k in range(1, longest + 1)])))


def _model(examples: DataFrame, settings: Settings) -> tuple[DataFrame, float]:
    """Weight in millionths and size by substring, and the weight of an unknown character.

    ``examples`` has ``text`` and ``accepted``, 1 or 0.
    """
    sides = ("accepted", "rejected")
    counts = (
        _substrings(examples, settings.order + 1)
        .groupBy("s")
        .agg(F.sum("accepted").alias("accepted"), F.sum(1 - F.col("accepted")).alias("rejected"))
    )
    counts = settled(counts, "substrings")
    # Positions that are predicted: all but the start.
    size = F.col("accepted") + F.col("rejected")
    alone = counts.filter((F.length("s") == 1) & (F.col("s") != START))
    totals = alone.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sides]).first()
    least = settings.min_share * (totals[0] + totals[1])
    kept = counts.filter(size >= least).withColumn("length", F.length("s")).withColumn("size", size)
    after = counts.filter((F.length("s") > 1)).groupBy(
        F.substr("s", F.lit(1), F.length("s") - 1).alias("s")
    )
    contexts = after.agg(*[F.sum(c).alias(c) for c in sides]).filter(size >= least)
    m, uniform = settings.mass, 1.0 / settings.alphabet
    unknown = {c: m * uniform / (totals[c] + m) for c in sides}

    contexts = settled(
        contexts.select(
            F.col("s").alias("context"),
            size.alias("uses"),
            *[(F.col(c) + m).alias(f"{c}_all") for c in sides],
            (F.log(m / (F.col("accepted") + m)) - F.log(m / (F.col("rejected") + m))).alias("shorter"),
        ),
        "contexts",
    )
    level = kept.filter((F.col("length") == 1) & (F.col("s") != START)).select(
        "s",
        "size",
        *[((F.col(c) + m * uniform) / (totals[c] + m)).alias(f"p_{c}") for c in sides],
    )
    base = F.log(F.lit(unknown["accepted"])) - F.log(F.lit(unknown["rejected"]))
    grams = level.select("s", "size", (F.log("p_accepted") - F.log("p_rejected") - base).alias("gain"))
    for k in range(2, settings.order + 2):
        shorter = level.select(
            F.col("s").alias("suffix"), *[F.col(f"p_{c}").alias(f"q_{c}") for c in sides]
        )
        joined = (
            kept.filter(F.col("length") == k)
            .withColumn("suffix", F.substr("s", F.lit(2), F.lit(k)))
            .withColumn("context", F.substr("s", F.lit(1), F.lit(k - 1)))
            .join(shorter, "suffix")
            .join(contexts, "context")
        )
        p = [((F.col(c) + m * F.col(f"q_{c}")) / F.col(f"{c}_all")).alias(f"p_{c}") for c in sides]
        level = settled(joined.select("s", "size", "q_accepted", "q_rejected", "shorter", *p), "order")
        gain = (F.log("p_accepted") - F.log("q_accepted")) - (F.log("p_rejected") - F.log("q_rejected"))
        grams = grams.unionAll(level.select("s", "size", (gain - F.col("shorter")).alias("gain")))
    both = grams.unionAll(contexts.select(F.col("context").alias("s"), "uses", F.col("shorter").alias("gain")))
    weights = both.groupBy("s").agg(
        F.sum(F.round(F.col("gain") * _MICRO).cast("long")).alias("weight"),
        F.max("size").alias("size"),
        F.lit(totals[0] + totals[1]).alias("positions"),
    )
    first = examples.sparkSession.range(1).select(F.round(base * _MICRO).cast("long")).first()[0]
    return settled(weights, "weights"), first


def _scores(texts: DataFrame, weights: DataFrame, unknown: int, settings: Settings) -> DataFrame:
    """``text`` and ``score`` of every different text."""
    table = settled(texts.select(F.monotonically_increasing_id().alias("id"), F.col("text")), "texts")
    found = _substrings(table, settings.order + 1)
    many = weights.count() > settings.most_sent
    sent = weights.filter(F.col("size") >= settings.hot_share * F.col("positions")) if many else weights
    found = found.join(F.broadcast(sent.select("s", "weight")), "s", "left")
    parts = found.select("id", F.coalesce("weight", F.lit(0)).alias("weight"))
    if many:
        rare = weights.filter(F.col("size") < settings.hot_share * F.col("positions"))
        asked = found.filter("weight IS NULL").groupBy("s", "id").agg(F.count("*").alias("times"))
        joined = asked.join(rare.select("s", "weight"), "s")
        parts = parts.unionAll(joined.select("id", F.col("times") * F.col("weight")))
    sums = parts.groupBy("id").agg(F.sum("weight").alias("sum")).join(table, "id")
    n = F.length("text") - 1
    score = (F.col("sum") + unknown * n) / n / _MICRO
    return sums.select("text", score.alias("score"))


def _threshold(scored: DataFrame, settings: Settings) -> float:
    """The multiple of the step that best separates the examples, the lowest of equals.

    ``scored`` has ``score`` and ``accepted``. Zero without examples of both kinds.
    """
    bins = F.floor(F.greatest(F.least("score", F.lit(settings.limit)), F.lit(-settings.limit)) / settings.step)
    counts = (
        scored.groupBy(bins.alias("bin"))
        .agg(F.sum("accepted").alias("accepted"), F.sum(1 - F.col("accepted")).alias("rejected"))
        .orderBy("bin")
        .collect()
    )
    accepted, rejected = sum(r[1] for r in counts), sum(r[2] for r in counts)
    if not accepted or not rejected:
        return 0.0
    best, threshold, below_a, below_r = -1.0, 0.0, 0, 0
    for r in counts:
        # All below this bin rejected.
        gained = below_r * accepted - below_a * rejected
        if gained > best:
            best, threshold = gained, r["bin"] * settings.step
        below_a, below_r = below_a + r["accepted"], below_r + r["rejected"]
    return threshold


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, settings: Settings = Settings()
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every row.

    A null URL or one without ``://`` has neither host nor path and is scored as
    the empty text it then is. Without accepted or rejected examples all scores
    are 0 and whatever no rule blocks is allowed. Repeated rows are judged alike.
    """
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    parsed = computed(pages.select("page_id", "url"), host=host, path=path).drop("url")
    ruled = parsed.select(
        "page_id", "host", "path",
        _first_fit(rules, lambda r: F.lit(r.text)).alias("rule"),
        _first_fit(rules, lambda r: F.lit(r.verdict)).alias("ruled"),
        F.concat(F.lit(START), "host", "path", F.lit(END)).alias("text"),
    )
    examples = ruled.filter("ruled IS NOT NULL").select(
        "text", (F.col("ruled") == "allow").cast("int").alias("accepted")
    )
    held = F.crc32(F.col("text").cast("binary")) % settings.folds == 0
    learnt = examples.filter(~held)
    weights, unknown = _model(learnt, settings)
    kinds = learnt.agg(F.min("accepted"), F.max("accepted")).first()
    texts = ruled.select("text").distinct()
    scores = settled(_scores(texts, weights, unknown, settings), "url-scores")
    if kinds[0] == kinds[1]:
        scores, threshold = scores.withColumn("score", F.lit(0.0)), 0.0
    else:
        threshold = _threshold(examples.filter(held).join(scores, "text"), settings)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return ruled.join(scores, "text").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "score"
    )
