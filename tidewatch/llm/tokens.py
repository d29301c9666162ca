"""Token ids of whole texts, by a public tokenizer, with a cache of words per Python worker.

The tokenizer drops white space between words, never joins across it, lowers case, and splits
where signs follow a letter. So a text's ids are those of its words in order, lowered and set
apart from signs. Equal words of a slice of texts are brought together by Arrow, looked up once,
and their ids dealt out to all places; a worker keeps the ids of words while it lives. The cache is
emptied beyond ``CACHED`` words. Tests compare with encoding whole texts. A tokenizer that describes
itself otherwise encodes whole texts.
"""

from __future__ import annotations

import gc
import json
import os
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

CACHED = 500_000
#: Words encoded as one text, and texts handed over at once: each token is an object meanwhile.
JOINED, HANDED = 256, 16
#: Bytes of text encoded at once: its words are held as objects meanwhile.
SLICE = 1 << 20
_SPACE = bytes(0x20 if c in (0x09, 0x0A, 0x0D) else c for c in range(256))
_PLAIN = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in _SPACE)
_BLANK, _LETTER, _SIGN = 1, 2, 3
_KINDS = np.array([
    _BLANK if c == 0x20 else _LETTER if 0x61 <= c <= 0x7A else _SIGN if c in b".,!?;:#$%&*|" else 0
    for c in range(256)], np.uint8)
_SPECIAL = b"<|"
# How a tokenizer must describe itself for its texts to be encoded word by word.
BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "behavior": "Removed", "invert": True, "pattern": {
            "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids as little-endian 16-bit integers; the vocabulary must be smaller than 65,536."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer need more than 16 bits")
        self.known: dict[bytes, bytes] = {b"": b""}
        described = json.loads(self.tokenizer.to_str())
        self.by_word = (all(described[k] == v for k, v in BY_WORD.items()) and all(
            t["special"] and t["content"].startswith("<|") for t in described["added_tokens"]))

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u2").tobytes() for e in found]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Words of letters only: encoded many at a time, told apart by the word numbers."""
        out: list[bytes] = []
        parts = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        for at in range(0, len(parts), HANDED):
            some = parts[at:at + HANDED]
            texts = [b" ".join(p).decode() for p in some]
            for part, found in zip(
                    some, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
                number = found.word_ids
                if number and None not in number and number[-1] == len(part) - 1:
                    ids = np.array(found.ids, "<u2").tobytes()
                    ends = (2 * np.searchsorted(
                        np.array(number), np.arange(len(part)), side="right")).tolist()
                    out += [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                else:
                    out += self._plain([w.decode() for w in part])
        return out

    def _learn(self, chunks: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of the given chunks, which are kept from now on."""
        if len(self.known) > CACHED:
            self.known = {b"": b""}
        words, others = [], []
        for chunk in chunks:
            # Letters beyond are left alone: some are decomposed, or turn into signs in lower case.
            letters = chunk.isalpha() or (
                not chunk.isascii() and (s := chunk.decode()).lower().isalpha() and max(s) < "ɐ")
            (words if letters else others).append(chunk)
        out = dict(zip(words, self._words(words), strict=True))
        out.update(zip(others, self._plain([w.decode() for w in others]), strict=True))
        self.known.update(out)
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as bytes of 16-bit integers."""
        if not self.by_word:
            return self._plain([t.decode() for t in texts])
        collects = gc.isenabled()
        gc.disable()  # else the collector walks over the growing cache again and again
        try:
            special = [_SPECIAL in t for t in texts]
            found = self._joined([b"" if s else t for s, t in zip(special, texts, strict=True)])
            for i in np.flatnonzero(special):
                chunks = texts[i].translate(_SPACE).split(b" ")
                found[i] = b"".join(self._known(chunks))
            return found
        finally:
            if collects:
                gc.enable()
            # Both allocators keep what a slice took for a while; it is more than the cache takes.
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()

    def _known(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks, from the cache or learnt."""
        found = list(map(self.known.get, chunks))
        if None in found:
            new = self._learn({c for c, ids in zip(chunks, found, strict=True) if ids is None})
            found = [new[c] if ids is None else ids for c, ids in zip(chunks, found, strict=True)]
        return found

    def _joined(self, texts: list[bytes]) -> list[bytes]:
        """All texts at once: equal chunks are brought together before any is looked up."""
        joined = b" ".join(texts).translate(_PLAIN)
        kinds = _KINDS[np.frombuffer(joined, np.uint8)]
        # A chunk begins after a space, or with a sign after a letter; spaces trail their chunk.
        begins = kinds != _BLANK
        begins[1:] &= (kinds[:-1] == _BLANK) | ((kinds[:-1] == _LETTER) & (kinds[1:] == _SIGN))
        starts = np.flatnonzero(begins)
        if not len(starts):
            return [b""] * len(texts)
        offsets = np.append(starts, len(joined)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
        _, places, held = chunks.dictionary.buffers()
        held, cuts = held.to_pybytes(), np.frombuffer(places, np.int32)[:len(chunks.dictionary) + 1].tolist()
        ids = self._known([held[a:b].rstrip(b" ") for a, b in zip(cuts, cuts[1:], strict=False)])
        sizes = np.array([len(i) for i in ids], np.int64) // 2
        firsts, which = np.cumsum(sizes) - sizes, np.asarray(chunks.indices)
        counts = sizes[which]
        ends = np.cumsum(counts)
        # Place of every id among those of the distinct chunks.
        at = np.arange(ends[-1]) + np.repeat(firsts[which] - (ends - counts), counts)
        out = np.frombuffer(b"".join(ids), "<u2")[at].tobytes()
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = np.append(0, ends)[np.searchsorted(starts, np.append(0, text_ends))] * 2
        return [out[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
