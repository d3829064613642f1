"""Token ids of whole texts, by the tokenizers library.

``encoder(path)`` gives one encoder per Python worker. Files whose pipeline works word by word (white space ends a word,
NFC, lower case, a split into letter, digit and other runs, byte-level BPE with word ends) are encoded through a bounded
memo of words. Texts in Latin-1 are split as one array of bytes, a closing mark from its word too, and each different word of
a batch is looked up once; words not met before are sent to the library together, in one call for a batch of texts. Every
other file, and every word the memo's rules do not cover, goes through the library's full pipeline.
"""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs one task per core

# Most words the memo holds, and the longest of them: some 70 MB per Python worker.
MEMO_WORDS = 400_000
MEMO_LETTERS = 64

# Runs of letters, single digits, runs of anything else, after the contractions: the file's own split, for Latin-1.
_RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
# Characters whose class, case or composition differs between libraries, or that may start a special token.
_ODD_WORD = re.compile(r"<\||[\x00-\x20\x7f-\xa0²³¹¼½¾]|[^\x00-\xff]")
# White space of one library and not of the other.
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
# Of Latin-1, what is odd in a word, or white space beyond that of ASCII.
_ODD_BYTES = bytes([*range(9), *range(14, 32), *range(0x7F, 0xA1), *"²³¹¼½¾".encode("latin-1")])
_BLANK, _LETTER, _MARK, _OTHER = range(4)
_KINDS = np.array(
    [
        _BLANK if c in " \t\n\v\f\r" else _LETTER if c.isalpha() or c in "0123456789" else _MARK if c in ".,;:!?" else _OTHER
        for c in map(chr, range(256))
    ],
    np.uint8,
)


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.path = path
        self.memo: dict[str, bytes] = {}
        self.by_word = _works_by_word(config)
        if self.by_word:
            self.bpe = Tokenizer.from_str(
                json.dumps(config | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []})
            )
            suffix = config["model"]["end_of_word_suffix"]
            vocabulary = config["model"]["vocab"]
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            pairs = {pair for c in map(chr, range(0x80, 0x100)) for pair in zip(c.encode().decode("latin-1"), level.pre_tokenize_str(c)[0][0])}
            # Most bytes stand for themselves.
            self.visible = [pair for pair in pairs if pair[0] != pair[1]]

    @cached_property
    def full(self):
        """The file as it is; few texts need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if not self.by_word:
            return self._whole([text or "" for text in texts])
        found = [_lowered(text) for text in texts]
        simple = [k for k, data in enumerate(found) if data is not None]
        others = [k for k, data in enumerate(found) if data is None]
        for k, ids in zip(simple, self._simple([found[k] for k in simple])):
            found[k] = ids
        if others:
            words = [_split(texts[k]) for k in others]
            different = list(set(chain.from_iterable(words)))
            known = dict(zip(different, self._looked_up(different)))
            for k, own in zip(others, words):
                found[k] = b"".join([known[word] for word in own])
        return found

    def _simple(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts as ``_lowered`` gives them: words are numbered in Arrow, and their ids put in place by number."""
        data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
        kinds = _KINDS[data]
        inside = kinds != _BLANK
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        # A mark between a letter or digit and white space is a run, and so a word, of its own.
        first[1:-1] |= (kinds[1:-1] == _MARK) & (kinds[:-2] == _LETTER) & ~inside[2:]
        at = np.flatnonzero(first)
        if not len(at):
            return [b""] * len(texts)
        letters = data[inside]
        places = np.append(np.cumsum(inside, dtype=np.int32)[at] - 1, len(letters)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(places), pa.py_buffer(letters)])
        numbers = words.dictionary_encode()
        different = numbers.dictionary.to_numpy(zero_copy_only=False)
        ids = self._looked_up([word.decode("latin-1") for word in different])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, which = np.cumsum(sizes) - sizes, numbers.indices.to_numpy()
        per_word = sizes[which]
        after = np.concatenate([[0], np.cumsum(per_word)])
        every = np.frombuffer(b"".join(ids), "<u4")
        placed = every[np.repeat(starts[which] - after[:-1], per_word) + np.arange(after[-1])].tobytes()
        ends = np.cumsum([0, *[len(text) + 1 for text in texts]])
        cuts = (4 * after[np.searchsorted(at, ends)]).tolist()
        return [placed[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _looked_up(self, words: list[str]) -> list[bytes]:
        """Ids of different words; those not met before are remembered."""
        ids = list(map(self.memo.get, words))
        unseen = [word for word, own in zip(words, ids) if own is None]
        if unseen:
            found = self._unseen(unseen)
            ids = [found[word] if own is None else own for word, own in zip(words, ids)]
            self._remember(found)
        return ids

    def _remember(self, found: dict[str, bytes]) -> None:
        """Frequent words come early in any text: a full memo keeps the half it learned first."""
        self.memo.update((word, ids) for word, ids in found.items() if len(word) <= MEMO_LETTERS)
        if len(self.memo) > MEMO_WORDS:
            self.memo = dict(islice(self.memo.items(), MEMO_WORDS // 2))

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.full.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def _unseen(self, words: list[str]) -> dict[str, bytes]:
        # Lower-case Latin-1 letters are one run.
        runs = [word for word in words if word.isalpha()]
        joined = "".join(runs)
        if _beyond_latin(joined) or joined != joined.lower():
            runs = []
        found = self._runs(runs)
        rest = [word for word in words if word not in found] if len(runs) < len(words) else []
        return found | self._mixed(rest) if rest else found

    def _mixed(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that may have several runs."""
        # Joined by a letter, words have an odd character only if one of them has.
        odd = [word for word in words if _ODD_WORD.search(word)] if _ODD_WORD.search("a".join(words)) else []
        found = dict(zip(odd, self._whole(odd)))
        plain = [word for word in words if word not in found] if odd else words
        runs = [_runs_of(word.lower()) for word in plain]
        every = set(chain.from_iterable(runs))
        # A run is a word of its own, which may have been met as one.
        ids_of = {run: self.memo[run] for run in every & self.memo.keys()}
        ids_of |= self._runs(list(every - ids_of.keys()))
        for word, own in zip(plain, runs):
            found[word] = ids_of[own[0]] if len(own) == 1 else b"".join([ids_of[run] for run in own])
        return found

    def _runs(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of each run, all encoded in one call: a run's last token, and no other, has the word-end suffix."""
        if not runs:
            return {}
        joined = " ".join(runs)
        if not joined.isascii():
            joined = joined.encode().decode("latin-1")
            for byte, shown in self.visible:
                joined = joined.replace(byte, shown)
        ids = np.array(self.bpe.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        data = ids.tobytes()
        return {run: data[start:end] for run, start, end in zip(runs, [0, *ends], ends)}


def _runs_of(word: str) -> list[str]:
    if word.isalpha():
        return [word]
    return [word[:-1], word[-1]] if word[-1] in ".,;:!?" and word[:-1].isalpha() else _RUNS.findall(word)


def _beyond_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return False


def _lowered(text: str | None) -> bytes | None:
    """A text in lower case as Latin-1, if its characters are of it and none is odd; else None."""
    if not text:
        return b""
    if "<|" in text:
        return None
    try:
        data = text.lower().encode("latin-1")
    except UnicodeEncodeError:
        return None
    return data if len(data.translate(None, _ODD_BYTES)) == len(data) else None


def _split(text: str | None) -> list[str]:
    if not text:
        return []
    if _ODD_SPACE.search(text):
        return re.split(r"[ \t\n\r]+", text.strip(" \t\n\r"))
    if "<|" not in text:
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
    return text.split()


def _works_by_word(config: dict) -> bool:
    steps = [step["type"] for step in (config.get("normalizer") or {}).get("normalizers", [])]
    splits = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and [step["type"] for step in splits] == ["Split", "ByteLevel"]
        and splits[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
        and not splits[1]["use_regex"]
        and bool(config["model"].get("end_of_word_suffix"))
        and config.get("post_processor") is None
    )


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
