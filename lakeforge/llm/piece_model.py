"""A sentencepiece model's parts that its library does not hand out.

The library does the merging; this module reads the model file for the
normaliser's settings, the compiled character map and the kinds of pieces,
and tells for each piece which bytes of the original text it stands for.
"""

from __future__ import annotations

from functools import cache

import numpy as np

from lakeforge.llm.common import vocabulary

# Fixed values of the model file format: piece kinds, and the mark for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
SPACE = "▁".encode()


def fields(data: bytes) -> dict[int, list]:
    """A serialised message's values by field number: ints, or bytes of any length."""
    out: dict[int, list] = {}
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at : at + size]
            at += size
        out.setdefault(tag >> 3, []).append(value)
    return out


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 keys, and their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.pool = blob[4 + size :]

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << (8 if unit & 512 else 0)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that ``data`` has at ``at``, and what replaces it."""
        if not self.units:
            return None
        found, node = None, self._jump(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._jump(unit)
            if unit & 256:  # a key ends here; its value is the place in the pool
                begin = self.units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.pool[begin : self.pool.index(0, begin)]
        return found


class PieceModel:
    """The library's processor with the normaliser's alignment beside it."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            model = fields(f.read())
        trainer, rules = fields(model[2][0]), fields(model[3][0])
        self.is_bpe = trainer.get(3, [1])[-1] == BPE
        self.suffix_space = bool(trainer.get(24, [0])[-1])
        self.map = CharacterMap(rules.get(2, [b""])[-1])
        self.dummy_prefix, self.squeeze, self.escape = (bool(rules.get(k, [1])[-1]) for k in (3, 4, 5))
        self.end_id = self.library.eos_id()
        pieces = [(p[1][0], p.get(3, [NORMAL])[-1]) for p in map(fields, model[1])]
        self.kind = np.array([k for _, k in pieces])
        # Bytes of normalised text per piece; -1: it depends on the text.
        self.width = np.array([{UNKNOWN: -1, CONTROL: 0, BYTE: 1}.get(k, len(p)) for p, k in pieces])
        self.symbols = sorted((p for p, k in pieces if k == USER_DEFINED), key=len, reverse=True)
        # Bytes of original text per piece where the normaliser only writes spaces as marks.
        self.source = self.width - 2 * np.array([p.count(SPACE) if k in (NORMAL, USER_DEFINED, UNUSED) else 0 for p, k in pieces])
        self.byte_fallback = bool((self.kind == BYTE).any())
        self.plain = not (self.map.units or self.squeeze or self.symbols or self.suffix_space) and self.escape and self.byte_fallback

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each (and the end) its place in the original bytes.

        At every place the longest user symbol is kept as it is, else the
        longest key of the character map is replaced, else one character is
        copied. Copied bytes map one to one; bytes of a replacement all map
        to where the replaced run begins.
        """
        data, out, origin = text.encode(), bytearray(), []
        space = SPACE if self.escape else b" "

        def write(piece: bytes, at: int, copied: bool) -> None:
            for i, byte in enumerate(piece):
                mark = space if byte == 32 else piece[i : i + 1]
                out.extend(mark)
                origin.extend([at + i * copied] * len(mark))

        at = 0
        after_space = self.squeeze  # leading spaces go
        started = False
        while at < len(data):
            symbol = next((s for s in self.symbols if data.startswith(s, at)), None)
            hit = None if symbol else self.map.longest(data, at)
            if hit:
                size, piece = hit
            else:
                lead = data[at]
                size = len(symbol) if symbol else 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
                piece = data[at : at + size]
            skipped = 0
            while after_space and piece[skipped : skipped + 1] == b" ":
                skipped += 1
            if not started and (not self.squeeze or len(piece) > skipped):
                if self.dummy_prefix and not self.suffix_space:
                    write(b" ", at, False)
                started = True
            write(piece[skipped:], at + skipped * (not hit), not hit)
            if self.squeeze and len(piece) > skipped:
                after_space = piece.endswith(b" ")
            at += size
        end = len(data)
        while self.squeeze and out.endswith(space):
            del out[-len(space) :]
            end = origin[len(out)]
            del origin[len(out) :]
        if started and self.dummy_prefix and self.suffix_space:
            out.extend(space)
            origin.extend([end] * len(space))
        return bytes(out), np.array([*origin, end])

    def spans(self, text: str, ids: list[int], pieces: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Original byte spans (begin, end) of each piece; they follow each other without gaps."""
        code = np.array(ids, np.int64)
        if self.plain and "▁" not in text:
            ends = np.cumsum(self.source[code]) - self.dummy_prefix
            begins = np.concatenate(([0], ends[:-1]))[: len(ends)]
            size = len(text.encode())
        else:
            width = self.width[code]
            if (width < 0).any():  # an unknown piece is as long as its surface
                pieces = pieces or self.library.encode(text, out_type=str)
                width = np.where(width < 0, [len(p.encode()) for p in pieces], width)
            normal, origin = self.normalise(text)
            at = np.cumsum(width)
            if (at[-1] if len(at) else 0) != len(normal):
                raise ValueError("pieces do not cover the normalised text")
            ends, begins, size = origin[at], origin[np.concatenate(([0], at[:-1]))[: len(at)].astype(np.int64)], int(origin[-1])
        if len(ends) and ends[-1] != size:
            raise ValueError("pieces do not cover the text")
        return begins, ends


@cache
def load(name: str) -> PieceModel:
    """The model of a public vocabulary file, read once per worker."""
    return PieceModel(vocabulary(name))
