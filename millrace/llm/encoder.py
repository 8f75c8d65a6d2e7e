"""Encoding of many texts with the tokenizers library, each distinct word once.

The tokenizer in ``word_bpe_49k.json`` splits a text into words, digits and runs of other
signs, and merges within such a piece only. The ids of a text are therefore those of its
pieces, and a piece met before need not be encoded again. Finding the pieces is done on
whole buffers with numpy. Texts outside ASCII and Latin-1 letters, and any other tokenizer,
go through the library itself, which also encodes every piece that is new.
"""

from __future__ import annotations

import json

import numpy as np

from millrace.llm.arrow import spans

# The rules of a tokenizer whose pieces can be found here.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
SHORT_ENDINGS = b"stmd"
LONG_ENDINGS = (b"re", b"ve", b"ll")

SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
KEY_BYTES = 16
SLOT_BITS = 18


def _classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[0x21:0x7F] = SIGN
    for low, high in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0xC0)):
        out[low:high] = LETTER
    out[0xC3] = LETTER  # first byte of the letters from 0xC0 to 0xFF
    out[0x30:0x3A] = DIGIT
    out[[0x20, 0x09, 0x0A, 0x0D]] = SPACE
    return out


def _lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 0x20
    out[0x80:0x9F] += 0x20  # second byte of capital letters in Latin-1
    return out


def _byte_signs() -> np.ndarray:
    """Bytes without a printable sign stand as the signs from 256 on, as byte-level BPE has it."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out = np.arange(256, dtype="<u2")
    rest = sorted(set(range(256)) - printable)
    out[rest] = 256 + np.arange(len(rest))
    return out


CLASSES, LOWER, BYTE_SIGNS = _classes(), _lower(), _byte_signs()
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def words64(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; the buffer has eight to spare."""
    return np.ndarray((len(buffer) - 7,), dtype="<u8", buffer=buffer, strides=(1,))


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-case buffer with spare bytes, starts, ends) of the pieces of all texts."""
    size = len(data)
    buffer = np.zeros(size + KEY_BYTES + 8, np.uint8)
    buffer[:size] = LOWER[data]
    kind = CLASSES[data]
    cut = np.ones(size, bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    cut[offsets[:-1][offsets[:-1] < size]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], size)
    kinds = kind[starts]
    lone = np.flatnonzero((buffer[starts] == 0x27) & (ends - starts == 1))
    lone = lone[lone + 1 < len(starts)]
    if len(lone):
        first_of_text = np.zeros(size + 1, bool)
        first_of_text[offsets] = True
        follows = lone[(kinds[lone + 1] == LETTER) & ~first_of_text[starts[lone + 1]]]
        at = starts[follows + 1]
        short = np.isin(buffer[at], np.frombuffer(SHORT_ENDINGS, np.uint8))
        pair = buffer[at].astype(np.uint16) * 256 + buffer[at + 1]
        long = np.isin(pair, [a * 256 + b for a, b in LONG_ENDINGS])
        long &= ends[follows + 1] - at >= 2
        taken = np.where(short, 1, np.where(long, 2, 0))
        ends[follows] += taken
        starts[follows + 1] += taken
    kept = (kinds != SPACE) & (ends > starts)
    return buffer, starts[kept], ends[kept]


def foreign(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, whether it holds anything that ``pieces`` does not cover."""
    bad = CLASSES[data] == OTHER
    second = data[1:]
    bad[1:] |= (data[:-1] == 0xC3) & ((second == 0x97) | (second == 0xB7))
    bad[1:] |= (data[:-1] == 0x3C) & (second == 0x7C)  # may begin a special token
    at = np.flatnonzero(bad)
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, at, side="right") - 1] = True
    return out


class Encoder:
    """Ids of texts, equal to the library's with ``add_special_tokens=False``.

    Pieces of at most 16 bytes are remembered in a table of fixed size, in which a new piece
    replaces the one in its slot. Its memory is bounded and its content never changes ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        # Not from the file, so that its truncation and padding, if any, stay unused.
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_pieces = self._covered(rules)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        slots = 1 << SLOT_BITS
        self.low = np.zeros(slots, np.uint64)
        self.high = np.zeros(slots, np.uint64)
        self.count = np.zeros(slots, np.uint8)
        self.ids = np.zeros((slots, KEY_BYTES), self.dtype)

    @staticmethod
    def _covered(rules: dict) -> bool:
        normalizer = rules.get("normalizer") or {}
        splitter = rules.get("pre_tokenizer") or {}
        first, second = ([*(splitter.get("pretokenizers") or []), {}, {}])[:2]
        model = rules.get("model") or {}
        return (rules.get("post_processor") is None
                and [n.get("type") for n in normalizer.get("normalizers", [])] == NORMALIZERS
                and first.get("pattern") == {"Regex": PIECES} and bool(first.get("invert"))
                and second.get("type") == "ByteLevel" and not second.get("add_prefix_space")
                and not second.get("use_regex")
                and model.get("type") == "BPE" and not model.get("dropout")
                and model.get("end_of_word_suffix") == WORD_END)

    def encode_text(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _encode_pieces(self, buffer, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count of each piece), by the merges of the library's model alone."""
        signs, merge = BYTE_SIGNS[buffer].tobytes().decode("utf-16-le"), self.tokenizer.model.tokenize
        ids, counts = [], []
        for a, b in zip(starts.tolist(), ends.tolist()):
            found = merge(signs[a:b])
            ids += [token.id for token in found]
            counts.append(len(found))
        return np.array(ids, self.dtype), np.array(counts, np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts in a UTF-8 buffer."""
        odd = foreign(data, offsets) if self.by_pieces else np.ones(len(offsets) - 1, bool)
        if not odd.any():
            return self._encode_buffer(data, offsets)
        out = [None] * len(odd)
        plain = np.flatnonzero(~odd)
        if len(plain):
            lengths = offsets[plain + 1] - offsets[plain]
            part = data[spans(offsets[plain], lengths)]
            ids, bounds = self._encode_buffer(part, np.append(0, np.cumsum(lengths)))
            for k, row in enumerate(plain.tolist()):
                out[row] = ids[bounds[k]:bounds[k + 1]]
        for row in np.flatnonzero(odd).tolist():
            text = data[offsets[row]:offsets[row + 1]].tobytes().decode("utf-8", "replace")
            out[row] = self.encode_text(text)
        return np.concatenate(out), np.append(0, np.cumsum([len(x) for x in out]))

    def _encode_buffer(self, data, offsets) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        buffer, starts, ends = pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        length = ends - starts
        view = words64(buffer)
        low = view[starts] & MASKS[np.minimum(length, 8)]
        high = view[starts + 8] & MASKS[np.clip(length - 8, 0, 8)]
        mixed = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed ^= mixed >> np.uint64(29)
        slot = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        long = length > KEY_BYTES
        known = (self.low[slot] == low) & (self.high[slot] == high) & ~long
        rows, count = self.ids[slot], self.count[slot].astype(np.int64)
        missed = np.flatnonzero(~known & ~long)
        if len(missed):
            order = missed[np.lexsort((high[missed], low[missed]))]
            new = np.ones(len(order), bool)
            new[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
            one = order[new]
            ids, counts = self._encode_pieces(buffer, starts[one], ends[one])
            table = np.zeros((len(one), KEY_BYTES), self.dtype)
            table[np.arange(KEY_BYTES) < counts[:, None]] = ids
            which = np.cumsum(new) - 1
            rows[order], count[order] = table[which], counts[which]
            # Of new pieces that share a slot, the last one stays, in all four arrays.
            at = slot[one]
            self.low[at], self.high[at] = low[one], high[one]
            self.count[at], self.ids[at] = counts, table
        if long.any():
            at = np.flatnonzero(long)
            long_ids, long_counts = self._encode_pieces(buffer, starts[at], ends[at])
            rows[at], count[at] = 0, 0
            short = rows[np.arange(KEY_BYTES) < count[:, None]]
            count[at] = long_counts
            place = np.repeat(long, count)
            out = np.empty(len(place), self.dtype)
            out[~place], out[place] = short, long_ids
        else:
            out = rows[np.arange(KEY_BYTES) < count[:, None]]
        total = np.append(0, np.cumsum(count))
        return out, total[np.searchsorted(starts, offsets)]


class Decoder:
    """Text of ids, as the library's ``decode(ids, skip_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.tokens = None
        if tokenizer.decoder is not None:
            self.library = tokenizer
            return
        # Without a decoder of its own, a tokenizer joins its tokens by spaces.
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [(tokenizer.id_to_token(i) or "").encode() for i in range(size)]

    def decode(self, ids: np.ndarray) -> bytes:
        if self.tokens is None:
            return self.library.decode(ids.tolist(), skip_special_tokens=False).encode()
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


_ENCODERS: dict[str, Encoder] = {}
_DECODERS: dict[str, Decoder] = {}


def decoder_of(path: str) -> Decoder:
    """The worker's decoder for this file."""
    if path not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def encoder(path: str) -> Encoder:
    """The worker's encoder for this file; it outlives a task and keeps what it has met."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
