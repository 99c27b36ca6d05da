"""Encoding texts chunk by chunk: tokenizers that split at white space give a chunk the same ids in any text.

``mode`` "space": a chunk is a space and what follows up to the next one, as byte-level tokenizers attach a space to
the word behind it. Where a space touches other white space the cut isn't safe, and the text goes whole.
``mode`` "white": chunks are runs without white space, for tokenizers that drop white space. Python's split() also cuts at
U+001C to U+001F, which are no white space to tokenizers; texts that hold one go whole, as do texts with a special token's string.
"""
from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterable

import numpy as np

from .common import holds

TAIL = ".,;:!?*$%&#|<>()[]{}\"-_/\\=+~^@"


ODD_WHITE = "\x1c\x1d\x1e\x1f"
#: Bytes of remembered chunks in a worker, about; a longer chunk than LONG characters isn't remembered.
MOST_BYTES, LONG = 128 << 20, 200
#: What an entry takes besides its characters and ids, and the words of a joined run.
ENTRY_BYTES, RUN = 200, 100


class ChunkEncoder:
    """Ids as little-endian bytes per text; what the encoder gave for chunks is remembered.

    ``encode_many`` encodes whole strings; ``encode_words``, if given, words (each with ``space`` before it) in one go.
    Beyond ``most`` bytes the memory starts anew, between calls, so that a call finds all that it learned."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], mode: str, most: int = MOST_BYTES,
                 encode_words: Callable[[list[str], str], list[bytes]] | None = None, specials: Iterable[str] = ()):
        self.encode_many, self.most, self.specials = encode_many, most, tuple(specials)
        self.space = " " if mode == "space" else ""
        self.encode_words = encode_words or (lambda words, space: encode_many([space + w for w in words]))
        self.known: dict[str, bytes | None] = {}  # None: not safe to cut here
        self.bare: dict[str, bytes] = {}  # without the space: beginnings of texts, marks behind words
        self.held = 0

    def forget(self) -> None:
        self.known.clear()
        self.bare.clear()
        self.held = 0

    def _unsafe(self, word: str) -> bool:
        return bool(self.space) and (not word or word[0].isspace() or word[-1].isspace())

    def _goes_whole(self, text: str) -> bool:
        return any(x in text for x in self.specials) or not self.space and any(x in text for x in ODD_WHITE)

    def _learn_bare(self, words: Iterable[str]) -> None:
        new = [w for w in words if w not in self.bare]
        self.bare.update(zip(new, self.encode_many(new)))
        self.held += sum(ENTRY_BYTES + 3 * len(w) for w in new)

    def _learn(self, words: Iterable[str]) -> None:
        made: list[tuple[str, str, str]] = []
        stems: dict[str, None] = {}
        tails: dict[str, None] = {}
        known = self.known
        for w in words:
            stem = w.rstrip(TAIL)
            if len(stem) < len(w) and stem.isalpha():  # the tail is a pre-token of its own
                tail = w[len(stem):]
                made.append((w, stem, tail))
                tails[tail] = None
                if stem not in known:
                    stems[stem] = None
            elif self._unsafe(w):
                known[w] = None
            else:
                stems[w] = None
        self._learn_bare(tails)
        new = list(stems)
        known.update(zip(new, self.encode_words(new, self.space)))
        self.held += sum(map(len, new)) * 3 + ENTRY_BYTES * (len(new) + len(made))
        for w, stem, tail in made:
            known[w] = known[stem] + self.bare[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > self.most:
            self.forget()
        whole = [i for i, t in enumerate(texts) if self._goes_whole(t)]
        parts = [t.split(" ") for t in texts] if self.space else [t.split() for t in texts]
        for i in whole:
            parts[i] = [""] if self.space else []
        heads = [p.pop(0) for p in parts] if self.space else [""] * len(parts)
        self._learn(set().union(*parts).difference(self.known))
        long_heads = [i for i, h in enumerate(heads) if len(h) > LONG]
        once = dict(zip(long_heads, self.encode_many([heads[i] for i in long_heads])))
        self._learn_bare({h for h in heads if len(h) <= LONG})
        get = self.known.__getitem__
        out: list[bytes] = []
        for i, (h, p) in enumerate(zip(heads, parts)):
            try:
                if p and h and h[-1].isspace():
                    raise TypeError
                out.append((once[i] if i in once else self.bare[h]) + b"".join(map(get, p)))
            except TypeError:  # a cut that isn't safe
                whole.append(i)
                out.append(b"")
        for i, ids in zip(whole, self.encode_many([texts[i] for i in whole])):
            out[i] = ids
        return out


_loaded: dict[tuple[str, str], tuple[ChunkEncoder, int]] = {}


@holds("chunks")
def forget() -> None:
    for encoder, _ in _loaded.values():
        encoder.forget()


def library_encoder(path: str, mode: str) -> tuple[ChunkEncoder, int]:
    """(an encoder by the tokenizers library for the vocabulary file, bytes of an id); texts give the ids of a plain call without added tokens."""
    key = (path, mode)
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        code = "H" if t.get_vocab_size() <= 1 << 16 else "I"

        def many(texts: list[str]) -> list[bytes]:
            return [array(code, e.ids).tobytes() for e in t.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

        def words(new: list[str], space: str) -> list[bytes]:
            """Runs of words joined by spaces, cut back where each word ends."""
            width, out = array(code).itemsize, []
            for lo in range(0, len(new), 100 * RUN):
                runs = [new[k: k + RUN] for k in range(lo, min(len(new), lo + 100 * RUN), RUN)]
                for run, e in zip(runs, t.encode_batch([space + " ".join(r) for r in runs], add_special_tokens=False)):
                    ids = array(code, e.ids).tobytes()
                    past = np.fromiter((x[1] for x in e.offsets), np.int64, len(ids) // width)
                    ends = np.cumsum([len(w) + 1 for w in run]) - (0 if space else 1)
                    at = 0
                    for cut in (np.searchsorted(past, ends, side="right") * width).tolist():
                        out.append(ids[at:cut])
                        at = cut
            return out

        specials = [x.content for x in t.get_added_tokens_decoder().values()]
        _loaded[key] = (ChunkEncoder(many, mode, encode_words=words, specials=specials), array(code).itemsize)
    return _loaded[key]
