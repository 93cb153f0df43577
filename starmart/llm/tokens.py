"""Token ids of whole texts by a public tokenizer, with the work on repeated words done once.

``Encoder.encode`` gives the ids that ``tokenizers`` gives for each text, as little-endian
unsigned 32-bit numbers.  Where the tokenizer drops white space and splits by
``WORD_PATTERN``, the ids of a text are those of its words (stretches without ASCII white space)
one after the other, and the ids of a plain word those of its pieces; some megabytes of text are worked on
together, each distinct word once, and words and pieces seen before are looked up.  Words beyond plain Latin letters, digits and ASCII signs, and those that
may hold a special token, go through the tokenizer whole.  Any other tokenizer encodes
whole texts.
"""

from __future__ import annotations

import functools
import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# fixed values: the split of the tokenizers whose words can be told apart
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")

#: bytes of text whose words are looked up together, about
TOGETHER = 1 << 23
#: words (and pieces) remembered: the newest generation and the one before
REMEMBERED = 300_000


def parts_of(text: bytes, most: int = 1 << 20) -> Iterator[bytes]:
    """The text in parts of about ``most`` bytes that end where a word ends."""
    at = 0
    while at < len(text):
        cut = re.compile(rb"[\x20\x09-\x0D]").search(text, at + most) if len(text) - at > most else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


class Remembered(dict):
    """What ``make`` gives for a key; of two generations of ``most`` keys each the older one is forgotten."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        made = self.old.get(key)
        if made is None:
            made = self.make(key)
        self[key] = made
        return made


def packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Encoder:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        split = json.dumps(spec.get("pre_tokenizer"))
        normal = (spec.get("normalizer") or {}).get("normalizers", [])
        self.by_word = (json.dumps(WORD_PATTERN)[1:-1] in split and '"Removed", "invert": true' in split
                        and [n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"])
        self.words = Remembered(self._word, remembered)
        self.pieces = Remembered(self._piece, remembered)
        # how the tokenizer writes the bytes of accented letters
        self.letters = ({ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0]
                         for c in map(chr, range(0xDF, 0x100)) if c != "÷"} if self.by_word else {})

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if not self.by_word:
            yield from (np.frombuffer(self._whole(t.decode("utf-8", "replace")), "<u4") for t in texts)
            return
        held: list[str] = []
        ends, size = [], 0  # held parts that end a text
        rest: list[np.ndarray] = []  # ids of the text that goes on
        for text in texts:
            for part in parts_of(text):
                if size + len(part) > TOGETHER and held:
                    *done, last = self._together(held, ends)
                    yield from (np.concatenate([*rest, d]) if i == 0 and rest else d for i, d in enumerate(done))
                    rest = [*rest, last] if not done else [last]
                    held, ends, size = [], [], 0
                held.append(part.decode("utf-8", "replace"))
                size += len(part)
            ends.append(len(held))
        *done, _ = self._together(held, ends)
        yield from (np.concatenate([*rest, d]) if i == 0 and rest else d for i, d in enumerate(done))

    def _together(self, parts: list[str], ends: list[int]) -> list[np.ndarray]:
        """The ids of texts that end behind some parts, and those of what follows the last one."""
        split = pc.ascii_split_whitespace(pa.array(parts, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        known = list(map(self.words.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(known), "<u4")
        codes = coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[codes]
        begin = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(first[codes] - begin[:-1], counts)
        at += np.arange(begin[-1])
        ids = flat.take(at)
        words = split.offsets.to_numpy() - split.offsets[0].as_py()
        cuts = begin[words[[0, *ends, len(parts)]]]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _word(self, text: str) -> bytes:
        if "<|" in text or not _PLAIN.fullmatch(text):
            return self._whole(text)
        found = _PIECES.findall(text.lower())
        if len(found) == 1:
            return self.pieces[found[0]]
        return b"".join([self.pieces[piece] for piece in found])

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.translate(self.letters)
        return packed([t.id for t in self.tokenizer.model.tokenize(piece)])

    def _whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker process, with what it has seen so far."""
    return Encoder(path)
