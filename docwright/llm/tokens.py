"""Token ids of a byte-level BPE vocabulary for batches of whole texts.

A text is cut into pieces by array operations over its code points (letters, numbers, other signs, white space, each with the
space before it), and only pieces that the worker has not met are given to the BPE coder. The ids are those that the vocabulary
file's own library gives: `encode` takes special tokens in a text as ordinary text, `encode_with_added` gives them their ids.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docwright.llm.words import span_hashes, text_bytes

#: The cutting rule of this vocabulary, and the endings after an apostrophe that it names.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
CACHED_PIECES = 1_500_000


@functools.cache
def _classes() -> np.ndarray:
    kinds = np.full(sys.maxunicode + 1, _OTHER, dtype=np.uint8)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            kinds[code] = _LETTER
        elif kind == "N":
            kinds[code] = _NUMBER
    kinds[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return kinds


def piece_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a piece begins, as flags over the code points of several texts; `offsets` are the texts' starts, with the end."""
    n = len(codes)
    start = np.zeros(n + 1, dtype=bool)
    if not n:
        return start[:0]
    kind = _classes()[codes]
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    start[1:n] = (kind[1:] != kind[:-1]) | border[1:n]
    start[0] = True
    runs = np.flatnonzero(start[:n])
    ends = np.append(runs[1:], n)
    spaces = (kind[runs] == _SPACE) & ~border[ends]  # followed by something else in the same text
    last = ends[spaces] - 1
    start[last] = True
    start[last[codes[last] == 0x20] + 1] = False
    quotes = np.flatnonzero(codes == 0x27)
    quotes = quotes[start[quotes] & (quotes + 1 < n)]
    quotes = quotes[start[quotes + 1] & ~border[quotes + 1]]
    for at in quotes[kind[quotes + 1] == _LETTER].tolist():
        limit = at + 1
        while limit < n and limit - at < 3 and kind[limit] == _LETTER and not border[limit]:
            limit += 1
        after = "".join(map(chr, codes[at + 1:limit]))
        ending = next((e for e in ENDINGS if after.startswith(e)), None)
        if ending:
            start[at + 1] = False
            start[at + 1 + len(ending)] = True
    return start[:n]


def byte_values(token: str, back: dict[str, int] | None = None) -> bytes:
    """The bytes of a byte-level token, whose characters each stand for one byte."""
    back = back or byte_characters()
    return bytes(back[c] for c in token)


@functools.cache
def byte_characters() -> dict[str, int]:
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(0x100 + at): b for at, b in enumerate(b for b in range(256) if b not in set(plain))}


class Coder:
    """Codes batches of texts; keeps the ids of pieces it has met, up to a bound on memory."""

    cut = staticmethod(piece_starts)

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, added = content["model"]["vocab"], content["added_tokens"]
        if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in what stands beside them are not known here")
        self.added = {token["content"]: token["id"] for token in added}
        back = byte_characters()
        ranks = {byte_values(token, back): rank for token, rank in vocabulary.items() if all(c in back for c in token) and not token.startswith("<|")}
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        self._code = tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._begin()

    def _begin(self) -> None:
        self._known, self._at = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self._ids, self._ends = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the offset of each text's ids, with the end."""
        data, byte_offsets = text_bytes(texts)
        whole = bytes(data).decode("utf-8")
        codes = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        before = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80))) if len(data) != len(codes) else None
        offsets = byte_offsets if before is None else before[byte_offsets]
        starts = np.flatnonzero(self.cut(codes, offsets))
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        ends = np.append(starts[1:], len(codes))
        hashes, first, which = np.unique(
            span_hashes((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F), starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self._known, hashes)
        met = place < len(self._known)
        met[met] = self._known[place[met]] == hashes[met]
        slot = np.empty(len(hashes), dtype=np.int64)
        slot[met] = self._at[place[met]]
        new = np.flatnonzero(~met)
        ids, borders = self._ids, self._ends
        if len(new):
            made = [self._code(whole[a:b]) for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            slot[new] = len(borders) - 1 + np.arange(len(new))
            ids = np.concatenate([ids, np.fromiter((i for piece in made for i in piece), dtype=np.uint32)])
            borders = np.concatenate([borders, borders[-1] + np.cumsum([len(piece) for piece in made])])
            if len(self._known) + len(new) <= CACHED_PIECES:
                self._ids, self._ends = ids, borders
                self._known, self._at = np.insert(self._known, place[new], hashes[new]), np.insert(self._at, place[new], slot[new])
        slot = slot[which]
        lengths = borders[slot + 1] - borders[slot]
        total = np.concatenate(([0], np.cumsum(lengths)))
        flat = ids[np.repeat(borders[slot] - total[:-1], lengths) + np.arange(total[-1])]
        return flat, total[np.searchsorted(starts, offsets)]

    def encode_with_added(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Like `encode`, but each added token of the file in a text is one id, and what stands between is coded alone."""
        if not any(pc.any(pc.match_substring(texts, token)).as_py() for token in self.added):
            return self.encode(texts)
        border = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        split = [border.split(text) for text in texts.to_pylist()]  # text and token in turn
        given = np.array([self.added[part] if at % 2 else -1 for parts in split for at, part in enumerate(parts)], dtype=np.int64)
        ids, borders = self.encode(pa.array(["" if at % 2 else part for parts in split for at, part in enumerate(parts)], texts.type))
        total = np.concatenate(([0], np.cumsum(np.where(given < 0, np.diff(borders), 1))))
        is_added = np.zeros(total[-1], dtype=bool)
        is_added[total[:-1][given >= 0]] = True
        out = np.empty(total[-1], dtype=np.uint32)
        out[is_added], out[~is_added] = given[given >= 0], ids
        return out, total[np.concatenate(([0], np.cumsum([len(parts) for parts in split])))]


def blank_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a run of blanks begins, as flags over the code points of several texts."""
    start = np.zeros(len(codes) + 1, dtype=bool)
    start[offsets] = True
    start = start[:len(codes)]
    blank = (codes == 0x20) | (codes == 0x2581)  # one and the same for this vocabulary
    start[1:] |= blank[1:] & ~blank[:-1]
    return start


class PieceCoder(Coder):
    """Codes batches of texts that begin with a blank, by a piece vocabulary with byte fallback that would add that blank itself.

    Its rule joins no character to a blank behind it, so texts are cut before each run of blanks, and what lies between is coded alone.
    """

    cut = staticmethod(blank_starts)

    def __init__(self, path: str) -> None:
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
        if any("\u2581" in name.lstrip("\u2581") for name in names):
            raise ValueError("this vocabulary has pieces across blanks")
        self.token_bytes = [bytes([int(n[3:5], 16)]) if pieces.is_byte(i) else n.replace("\u2581", " ").encode() for i, n in enumerate(names)]
        alone = [pieces.piece_to_id("\u2581")]
        self._code = lambda piece: pieces.encode(piece[1:]) if len(piece) > 1 else alone
        self._begin()


@functools.cache
def piece_coder(path: str) -> PieceCoder:
    return PieceCoder(path)


@functools.cache
def coder(path: str) -> Coder:
    return Coder(path)
