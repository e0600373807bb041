"""Quality rules on how well a public vocabulary fits a text.

Words are tokenised one by one, as the vocabulary sees them after a blank. A
text that a tokenizer breaks up far more or less than other texts of its
language is most likely not prose: characters per token, tokens per word, the
share of bytes that no piece covers and the entropy of the tokens are compared
with bands, the quartiles of all sound documents of the language widened by a
multiple of their distance. Documents without language are banded by script. The
fewer documents a language has, the more its quartiles are drawn to its script's.
"""

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.llm.rows import quoted
from yearloom.llm.shingles import word_hashes
from yearloom.scratch import settled

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_KEPT_WORDS, _KEPT_LENGTH = 400_000, 64
#: First code points of scripts, by Unicode block.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0900, "Indic"), (0x0E00, "Southeast Asian"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "other"), (0x3040, "Kana"), (0x3100, "other"),
    (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"),
)
MEASURES = ("chars_per_token", "tokens_per_word", "byte_share", "token_entropy")
_SCHEMA = (
    "doc_id {id}, language string, script string, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, n_tokens long, "
    "chars_per_token double, tokens_per_word double, byte_share double, token_entropy double"
)


@dataclass(frozen=True)
class Settings:
    """The base rules, and how far a band reaches beyond the quartiles.

    The quartiles of a language are the mean of its own, weighted by its sound
    documents, and those of the document's script, weighted as ``prior``
    documents. ``slack`` is added to a band on either side, and the more of it
    the fewer sound documents the script has: twice as much for ``prior`` ones.
    """

    least_words: int = 50
    most_repeated_percent: int = 50
    reach: float = 3.0
    prior: float = 25.0
    slack: tuple[float, ...] = (0.02, 0.05, 0.02, 0.1)


class Pieces:
    """Piece ids of words and which of them are single bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self._model.get_piece_size()
        self.is_byte = np.array([self._model.is_byte(i) for i in range(size)])
        self._known: dict[str, bytes] = {}

    def ids(self, words: list[str]) -> np.ndarray:
        known = self._known
        missing = [w for w in dict.fromkeys(words) if w not in known]
        if missing:
            if len(known) + len(missing) > _KEPT_WORDS:
                self._known = known = {}
                missing = list(dict.fromkeys(words))
            for start in range(0, len(missing), 1000):
                part = missing[start : start + 1000]
                for word, found in zip(part, self._model.encode(part, num_threads=1)):
                    known[word] = np.array(found, "<u4").tobytes()
        ids = np.frombuffer(b"".join([known[w] for w in words]), "<u4")
        for word in missing:
            if len(word) > _KEPT_LENGTH:
                del known[word]
        return ids


def script_of(text: str) -> str:
    """The script of most letters; Latin for a text without."""
    # Letters before the second block are of the first script.
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    beyond = points[points >= SCRIPTS[1][0]].tolist()
    if not any(chr(p).isalpha() for p in beyond):
        return SCRIPTS[0][1]
    letters = "".join(filter(str.isalpha, text))
    points = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32)
    block = np.searchsorted([s for s, _ in SCRIPTS], points, "right") - 1
    counts: dict[str, int] = {}
    for i, n in enumerate(np.bincount(block).tolist()):
        counts[SCRIPTS[i][1]] = counts.get(SCRIPTS[i][1], 0) + n
    return max(counts, key=counts.get)


def _repeated(words: np.ndarray) -> int:
    """Words within three-word windows that occur twice or more."""
    if len(words) < 3:
        return 0
    m = np.uint64(0xD6E8FEB86659FD93)
    windows = (words[:-2] * m + words[1:-1]) * m + words[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[again + k] = True
    return int(covered.sum())


def measures(text: str | None, pieces: Pieces) -> tuple:
    """The figures of one text, in the order of the columns from ``n_words`` on."""
    text = text or ""
    words = _WORD.findall(text)
    if not words:
        return (0, 0, sum(text.count(c) for c in _SYMBOLS), 0, 0, 0, None, None, None, None)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if line in seen:
            duplicates += 1
        elif _WORD.search(line):
            seen.add(line)
    chars = sum(map(len, words))
    ids = pieces.ids(words)
    _, counts = np.unique(ids, return_counts=True)
    share = counts / len(ids)
    return (
        len(words), chars, sum(text.count(c) for c in _SYMBOLS), duplicates,
        _repeated(word_hashes(text.encode("utf-8", "surrogatepass"), lower=False)), len(ids),
        chars / len(ids), len(ids) / len(words), float(pieces.is_byte[ids].mean()),
        float(-(share * np.log2(share)).sum()),
    )


def _measure(pieces: Callable[[], Pieces]):
    def run(batches):
        own = pieces()
        for batch in batches:
            rows, kind = [], batch.column("doc_id").type
            for doc_id, lang, text in zip(*(batch.column(c) for c in ("doc_id", "lang", "text"))):
                text = text.as_py()
                script = script_of(text or "")
                language = lang.as_py() or f"script {script}"
                rows.append((doc_id.as_py(), language, script, *measures(text, own)))
            types = [kind, pa.string(), pa.string(), *[pa.int64()] * 6, *[pa.float64()] * 4]
            names = [c.split()[0] for c in _SCHEMA.split(", ")]
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def measured(docs: DataFrame, model: str) -> DataFrame:
    """Every document's base figures and token measures.

    ``model`` is the path of a vocabulary with byte fallback. The measures of a
    text without a word, or without text, are null.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    lang = F.col(quoted("lang")) if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", lang.cast("string").alias("lang"), "text")
    return rows.mapInArrow(_measure(lambda: Pieces(model)), _SCHEMA.format(id=kind))


def quartiles(sound: DataFrame, by: str) -> DataFrame:
    """Documents and both quartiles of each measure, by the given column."""
    return sound.groupBy(by).agg(
        F.count("*").alias(f"{by}_documents"),
        # Rounded, there are few different values to count, and the quartiles are exact.
        *[F.percentile(F.round(m, 3), F.array(F.lit(0.25), F.lit(0.75))).alias(f"{by}_{m}") for m in MEASURES],
    )


def band(measure: str, slack: float, settings: Settings) -> tuple[Column, Column]:
    """The lowest and highest value of a measure for the language and script of a row."""
    n, of_script = F.col("language_documents"), F.col("script_documents")
    low, high = [
        (n * F.get(f"language_{measure}", F.lit(k)) + settings.prior * F.get(f"script_{measure}", F.lit(k)))
        / (n + settings.prior)
        for k in (0, 1)
    ]
    around = (high - low) * settings.reach + slack * (1 + F.sqrt(settings.prior / of_script))
    return low - around, high + around


def judge(docs: DataFrame, model: str, settings: Settings = Settings()) -> DataFrame:
    """Every row's figures, ``base_failed`` and ``kept``.

    A document is kept if the base rules hold and every measure lies in the band
    of its language. Null and blank texts fail the base rules. Every row of
    ``docs`` gives one row; repeated ones count as often in the bands.
    """
    found = settled(measured(docs, model), "fertility")
    failed = (F.col("n_words") < settings.least_words) | (
        100 * F.col("n_repeat_words") > settings.most_repeated_percent * F.col("n_words")
    )
    rows = found.withColumn("base_failed", failed)
    sound = rows.filter("NOT base_failed")
    own = settled(quartiles(sound, "language"), "quartiles")
    of_script = settled(quartiles(sound, "script"), "quartiles")
    joined = rows.join(own, "language", "left").join(of_script, "script", "left")
    inside = F.lit(True)
    for m, slack in zip(MEASURES, settings.slack):
        low, high = band(m, slack, settings)
        inside &= F.col(m).between(low, high)
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return joined.select(*[c for c in rows.columns if c != "script"], kept.alias("kept"))
