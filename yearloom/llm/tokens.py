"""Token ids of texts, word by word, with the ids of seen words kept at hand."""

import json
import os
import re
from collections.abc import Callable
from unicodedata import is_normalized

import numpy as np

#: Words kept at most, and the longest word that is kept, in code points.
_KEPT_WORDS, _KEPT_LENGTH = 500_000, 64
#: Words that no step before the merges changes: lower-case Latin letters, of which
#: no two compose, and ASCII marks after them, which are a part of their own.
_PLAIN = re.compile("([a-zß-öø-ÿ]*)([!-/:-@[-`{-~]*)").fullmatch
#: The parts of a text for which that holds.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ONE_CALL = 200


def _lowered(text: str) -> str:
    """The text in lower case where the tokenizer's own steps give the same ids."""
    lower = text.lower()
    if text.isascii():
        return lower
    # Capital sigma has two lower-case forms, and letters with combining marks
    # may compose in one case only.
    plain = "Σ" not in text and is_normalized("NFC", text) and is_normalized("NFC", lower)
    return lower if plain else text


def _letters(word: str) -> bool:
    """Whether the tokenizer sees letters only, after its own steps too."""
    return word.isalpha() and (word.isascii() or word.lower().isalpha())


def _merges(tokenizer) -> Callable | None:
    """Encodes texts of plain words by the tokenizer's merges; None if it cuts texts otherwise."""
    from tokenizers import Tokenizer, pre_tokenizers

    steps = [tokenizer.normalizer, tokenizer.pre_tokenizer]
    steps = [json.loads(step.__getstate__()) if step else {} for step in steps]
    changes = [step["type"] for step in steps[0].get("normalizers", [])]
    cuts = steps[1].get("pretokenizers", [])
    known = changes == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
    if not known or cuts[0]["pattern"] != {"Regex": _PARTS}:
        return None
    if any(_PLAIN(token.content.lower()) for token in tokenizer.get_added_tokens_decoder().values()):
        return None
    bare = Tokenizer(tokenizer.model)
    bytes_only = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytes_only])
    return bare.encode_batch_fast


class WordTokenizer:
    """Ids of a lower-casing tokenizer with word ends that never joins words.

    Texts are cut at blanks and newlines and each part is encoded by itself,
    which gives the ids of the whole text. Words of letters alone are one word
    to the tokenizer too, so many are encoded in one call and told apart by the
    tokens that end a word. Those of Latin letters need the merges only and are
    spared the tokenizer's own patterns, if these are the known ones; marks at
    their ends are encoded once for all words.
    """

    def __init__(self, path: str, word_end: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._encode = tokenizer.encode_batch_fast
        vocabulary = tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(word_end)]] = True
        self._known: dict[str, bytes] = {"": b""}
        self._merge = _merges(tokenizer)

    def _one_by_one(self, words: list[str]) -> None:
        for word, found in zip(words, self._encode(words, add_special_tokens=False)):
            self._known[word] = np.array(found.ids, "<u4").tobytes()

    def _together(self, words: list[str], encode: Callable) -> None:
        found = encode([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._one_by_one(words)
        packed, start = ids.tobytes(), 0
        for word, end in zip(words, (4 * ends).tolist()):
            self._known[word] = packed[start:end]
            start = end

    def _learn(self, missing: set[str]) -> None:
        known, marked = self._known, []
        plain, letters, others = set(), [], set()
        for word in missing:
            if self._merge is not None and (parts := _PLAIN(word)):
                stem, marks = parts.groups()
                if marks:
                    marked.append((word, stem, marks))
                    if marks not in known:
                        others.add(marks)
                if stem not in known:
                    plain.add(stem)
            elif _letters(word):
                letters.append(word)
            else:
                others.add(word)
        for words, encode in ((list(plain), self._merge), (letters, self._encode)):
            for start in range(0, len(words), _ONE_CALL):
                self._together(words[start : start + _ONE_CALL], encode)
        if others:
            self._one_by_one(list(others))
        for word, stem, marks in marked:
            known[word] = known[stem] + known[marks]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers.

        What is new in all the texts is encoded together.
        """
        parts = [_lowered(text).replace("\n", " ").split(" ") for text in texts]
        known, different = self._known, set().union(*parts)
        missing = different.difference(known)
        if missing:
            if len(known) + 3 * len(missing) > _KEPT_WORDS:
                self._known = known = {"": b""}
                missing = different.difference(known)
            self._learn(missing)
        found = [b"".join(map(known.__getitem__, words)) for words in parts]
        for word in missing:
            if len(word) > _KEPT_LENGTH:
                del known[word]
        return found

    def ids(self, text: str) -> bytes:
        """The ids of one text."""
        return self.ids_of([text])[0]
