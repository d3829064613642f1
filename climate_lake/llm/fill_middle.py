"""Fill-in-middle transformation with content-defined chunks and memoised boundary summaries.

A text's units are its runs of ASCII letters and its other characters, one each; a document is cut in prefix, middle and
suffix at two places counted in units. A rolling hash over the last ``WINDOW`` bytes cuts each text into chunks where the
content says so, so that a passage two documents share falls into the same chunks in both. A chunk's boundary summary
(units, characters, whether it begins and ends with a letter) is kept in a cache by the chunk's fingerprint and used again
only if the kept bytes are equal. Summaries combine: units add up, less one wherever a run of letters goes on across a
chunk boundary. So the sums locate the one chunk that holds a cut, and only that chunk's bytes are searched for it.

Each task works on its own rows, without a shuffle; the cache is bounded and its content changes no result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climate_lake.llm.common import map_batches, small_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = "1"
# Of a hundred documents, those left plain, and of the others those with the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20

# Bytes the rolling hash sees (a power of two), mean bytes of a chunk as a power of two, and the most bytes of one.
WINDOW, MEAN_BITS, MOST = 32, 10, 1 << 14
# Bytes of chunks that one Python worker remembers.
CACHE_BYTES = 48 << 20

OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_random = np.random.default_rng(11)
# A byte of zero adds nothing: the hash at a text's beginning doesn't depend on what precedes it in the buffer.
_GEAR = np.concatenate([np.zeros(1, np.uint32), _random.integers(1, 1 << 32, 255, dtype=np.uint32)])
_CODES = np.arange(256)
_LETTER = ((_CODES >= 65) & (_CODES <= 90)) | ((_CODES >= 97) & (_CODES <= 122))
_CHARACTER = (_CODES & 0xC0) != 0x80


class Summary(NamedTuple):
    """What a chunk adds to the counts of the text it lies in."""

    units: int
    chars: int
    letter_first: bool
    letter_last: bool


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each place: the sum of a random word per byte, shifted by its distance."""
    found, reach = _GEAR[data], 1
    while reach < WINDOW:
        longer = found.copy()
        longer[reach:] += found[:-reach] << np.uint32(reach)
        found, reach = longer, 2 * reach
    return found


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """Ends of the chunks of each text. They depend on the text alone and never part the bytes of a character."""
    gap = bytes(WINDOW)
    data = np.frombuffer(gap.join([*texts, b""]), np.uint8)
    marks = rolling_hash(data) >> np.uint32(32 - MEAN_BITS) == 0
    marks[:-1] &= _CHARACTER[data[1:]]
    places = np.flatnonzero(marks) + 1
    starts = np.cumsum([0, *[len(text) + WINDOW for text in texts]])
    bounds = np.searchsorted(places, starts, side="right").tolist()
    made = []
    for k, text in enumerate(texts):
        ends, begin = [], 0
        for end in [*(places[bounds[k] : bounds[k + 1]] - starts[k]).tolist(), len(text)]:
            end = min(end, len(text))
            while end - begin > MOST:
                begin += MOST
                while not _CHARACTER[text[begin]]:
                    begin -= 1
                ends.append(begin)
            if end > begin:
                ends.append(end)
                begin = end
        made.append(ends)
    return made


def unit_starts(chunk: bytes) -> np.ndarray:
    """Whether a unit starts at each byte, for a chunk on its own."""
    data = np.frombuffer(chunk, np.uint8)
    letter = _LETTER[data]
    starts = _CHARACTER[data]
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return starts


def summarise(chunk: bytes) -> Summary:
    chars = np.count_nonzero(_CHARACTER[np.frombuffer(chunk, np.uint8)])
    return Summary(int(np.count_nonzero(unit_starts(chunk))), int(chars), bool(_LETTER[chunk[0]]), bool(_LETTER[chunk[-1]]))


class ChunkCache:
    """Summaries by content: an entry counts only if its bytes are those asked for."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.held = most, 0
        self.entries: dict[int, tuple[bytes, Summary]] = {}

    def summary(self, chunk: bytes) -> Summary:
        key = xxhash.xxh3_64_intdigest(chunk)
        entry = self.entries.get(key)
        if entry is not None and entry[0] == chunk:
            return entry[1]
        found = summarise(chunk)
        if entry is None:
            self.entries[key] = (chunk, found)
            self.held += len(chunk)
            if self.held > self.most:
                # The later half stays: copies mostly lie close together.
                self.entries = dict(islice(self.entries.items(), len(self.entries) // 2, None))
                self.held = sum(len(own) for own, _ in self.entries.values())
        return found


class Counted:
    """A text's unit and character counts at its chunk boundaries."""

    def __init__(self, text: bytes, ends: list[int], cache: ChunkCache):
        self.text, self.begins, self.ends = text, [0, *ends[:-1]], ends
        self.units, self.chars, self.joined = [0], [0], []
        last = False
        for begin, end in zip(self.begins, ends):
            own = cache.summary(text[begin:end])
            joined = last and own.letter_first
            self.joined.append(joined)
            self.units.append(self.units[-1] + own.units - joined)
            self.chars.append(self.chars[-1] + own.chars)
            last = own.letter_last
        self.n = self.units[-1]

    def place(self, unit: int) -> tuple[int, int]:
        """Byte and character where the given unit starts; the end of the text for the unit after the last."""
        if unit == self.n:
            return len(self.text), self.chars[-1]
        k = bisect_right(self.units, unit) - 1
        chunk = self.text[self.begins[k] : self.ends[k]]
        at = int(np.flatnonzero(unit_starts(chunk))[unit - self.units[k] + self.joined[k]])
        before = int(np.count_nonzero(_CHARACTER[np.frombuffer(chunk, np.uint8, at)])) if at else 0
        return self.begins[k] + at, self.chars[k] + before


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """Four numbers below 2^32 for a document; one without id draws as if its id had no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def _transformed(batches, seed: str, plain_percent: int, suffix_first_percent: int) -> Iterator[pa.RecordBatch]:
    cache, schema = ChunkCache(), pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()), ("output", pa.string()),
    ])
    for batch in small_batches(batches, "text", 2 << 20):
        texts = [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]
        rows = []
        for doc_id, text, ends in zip(batch.column("doc_id").to_pylist(), texts, chunk_ends(texts)):
            one, other, plain, order = draws(doc_id, seed)
            counted = Counted(text, ends, cache)
            marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
            if not text or marked or plain % 100 >= 100 - plain_percent:
                rows.append((doc_id, counted.n, "plain", None, None, text))
                continue
            first, second = sorted([one % (counted.n + 1), other % (counted.n + 1)])
            (a, a_chars), (b, b_chars) = counted.place(first), counted.place(second)
            prefix, suffix = PREFIX + text[:a], SUFFIX + text[b:]
            form = "spm" if order % 100 < suffix_first_percent else "psm"
            head = suffix + prefix if form == "spm" else prefix + suffix
            rows.append((doc_id, counted.n, form, a_chars, b_chars - a_chars, head + MIDDLE + text[a:b]))
        columns = [pa.array(list(column), pa.binary() if field.name == "output" else field.type) for column, field in zip(zip(*rows), schema)]
        if rows:
            columns[-1] = columns[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def fill_in_middle(
    documents: DataFrame,
    seed: str = SEED,
    plain_percent: int = PLAIN_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """Per row of ``doc_id, text``: ``doc_id, n`` (units), ``form``, characters of prefix and middle, and the ``output``.

    ``form`` is ``plain`` (the text as it is, without counts of characters), ``psm`` (prefix, suffix, middle) or ``spm``
    (suffix, prefix, middle). A null or empty text, and one that holds a mark, is plain. Form and cuts follow from the
    doc_id alone, so rows with equal ids and texts get equal outputs; rows with a null id all draw alike. Further columns
    are ignored, an empty table gives no rows.
    """
    rows = documents.select("doc_id", "text")
    return map_batches(
        rows, _transformed, OUTPUT, seed=seed, plain_percent=plain_percent, suffix_first_percent=suffix_first_percent
    )


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of."""
    first, second = PREFIX.decode(), SUFFIX.decode()
    middle = MIDDLE.decode()

    def parts(head: str, second: str) -> tuple[Column, Column, Column]:
        body = F.split(F.substr(output, F.lit(len(head) + 1)), second, 2)
        rest = F.split(body[1], middle, 2)
        return body[0], rest[0], rest[1]

    prefix, suffix, between = parts(first, second)
    psm = F.concat(prefix, between, suffix)
    suffix, prefix, between = parts(second, first)
    spm = F.concat(prefix, between, suffix)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
