"""Token ids by the ``tokenizers`` library, with the ids of frequent words kept.

Cutting a text before each single space or line break that stands between two
characters that aren't white space never changes its ids with the vocabularies
used here (their own first step cuts there as well), so such pieces are encoded
once and looked up afterwards.  Any other text goes to the library whole, and so
does every text with a vocabulary whose first steps aren't those of
:data:`STEPS`: the encoder compares them with its file when it is made.
"""

from __future__ import annotations

import contextlib
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import kept

#: Pieces whose ids are kept.
KEEP = 300_000
#: Characters encoded at a time, but for a longer text.
CHUNK = 1_000_000
#: The steps before the pieces of the two kinds of vocabulary for which cutting is known to change nothing.
STEPS = {
    True: (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}),
    False: (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        },
    ),
}
#: New pieces that the library gets in one text.
JOINED = 50
_BAR = "|"
_MARKS = ".,;:!?*%&#$"


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``spaced``: the vocabulary's pieces begin with the space before them (byte-level BPE).

    With such a vocabulary a single line break between other characters is a
    piece of its own; with the other kind it is a space like any other.
    """

    def __init__(self, path: str, spaced: bool, keep: int = KEEP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        plain = known["model"].get("type", "BPE") == "BPE" and not known["model"].get("dropout") and all(t["special"] for t in known["added_tokens"])
        self.whole = not plain or (known["normalizer"], known["pre_tokenizer"]) != STEPS[spaced]
        self.spaced, self.keep, self.first, self.rest, self.marks = spaced, keep, {}, {}, {}
        vocabulary = self.model.get_vocab()
        self.bar = vocabulary.get(f"{_BAR}</w>")
        # Byte-level pieces write a space as this letter.
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], lead: str) -> list[bytes]:
        """The ids of each word, encoded many at a time and told apart by the space or the bar between them."""
        out: list[bytes] = []
        for at in range(0, len(words), JOINED):
            own = words[at : at + JOINED]
            ids = np.array(self.model.encode_batch_fast([lead + (lead or f" {_BAR} ").join(own)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.begins[ids] if lead else ids == self.bar)
            raw = ids.tobytes()
            if len(cuts) == len(own) - (not lead) and (lead == "" or cuts[0] == 0):
                ends = [*(4 * cuts[1:] if lead else 4 * cuts).tolist(), len(raw)]
                begins = [0, *((4 * cuts[1:]).tolist() if lead else (4 * cuts + 4).tolist())]
                out += [raw[a:b] for a, b in zip(begins, ends)]
            else:
                out += self._encode([lead + w for w in own])
        return out

    def _learn(self, known: dict[str, bytes], asked: set[str], lead: str) -> dict[str, bytes]:
        if len(known) > self.keep:  # what is asked again stays
            known = {w: known[w] for w in asked if w in known}
        if len(self.marks) > self.keep:
            self.marks = {}
        bare, marked = set(), []
        for w in asked.difference(known):
            if not w or w[-1].isspace() or w[w[0] == "\n" :][0].isspace():
                continue
            # Marks that follow a letter, up to the piece's end, are always encoded by themselves.
            word = w.rstrip(_MARKS)
            if word != w and word and word[-1].lower().isalpha():
                marked.append((w, word, w[len(word) :]))
                w = word
            if w not in known:
                bare.add(w)
        odd = [w for w in bare if w[0] == "\n" or _BAR in w or (self.spaced and not lead)]
        new = list(bare.difference(odd))
        known.update(zip(odd, self._encode([w if w[0] == "\n" else lead + w for w in odd])))
        known.update(zip(new, self._words(new, lead)))
        ends = [m for m in {m for _, _, m in marked} if m not in self.marks]
        self.marks.update(zip(ends, self._encode(ends)))
        known.update((w, known[word] + self.marks[m]) for w, word, m in marked)
        return known

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is empty, and no text is cut."""
        batch: list[str] = []
        size = 0
        for t in texts:
            batch.append(t or "")
            size += len(batch[-1])
            if size > CHUNK:
                yield from self._batch(batch)
                batch, size = [], 0
        yield from self._batch(batch)

    def _spaced(self, text: str) -> str:
        """The text with a space before every piece."""
        if self.spaced:
            return text.replace("\n", " \n")
        with contextlib.suppress(UnicodeEncodeError):
            # The vocabulary's own lower-casing; the same as Python's for these letters at least.
            text.encode("latin-1")
            text = text.lower()
        return text.replace("\n", " ")

    def _batch(self, texts: list[str]) -> Iterator[bytes]:
        if not texts:
            return
        if self.whole:
            yield from self._encode(texts)
            return
        lead = " " if self.spaced else ""
        pieces = pc.split_pattern(pa.array([self._spaced(t) for t in texts], pa.string()), " ")
        coded, ends = pieces.values.dictionary_encode(), pieces.offsets.to_numpy().astype(np.int64)
        words, code = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        self.rest = self._learn(self.rest, set(words), lead)
        ids = list(map(self.rest.get, words))
        if lead:  # a text's first piece has no space before it
            heads = pieces.values.take(pa.array(ends[:-1])).to_numpy(zero_copy_only=False).tolist()
            self.first = self._learn(self.first, set(heads), "")
            code[ends[:-1]] = len(words) + np.arange(len(texts))
            ids += map(self.first.get, heads)
        # Each piece's ids, one after the other, and then the texts' as runs of those.
        unknown = np.array([i is None for i in ids])  # white space beside a cut
        size = np.fromiter(map(len, (i or b"" for i in ids)), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(filter(None, ids)), "<u4")
        each = size[code]
        stop = np.concatenate(([0], np.cumsum(each)))
        whole = flat[np.repeat((np.cumsum(size) - size)[code] - stop[:-1], each) + np.arange(stop[-1])]
        edge, odd = stop[ends], np.logical_or.reduceat(unknown[code], ends[:-1])
        for t, x, y, other in zip(texts, edge[:-1].tolist(), edge[1:].tolist(), odd.tolist()):
            yield self._encode([t])[0] if other else whole[x:y].tobytes()


def encoder(path: str, spaced: bool) -> Encoder:
    """The encoder of this Python process; later tasks find what earlier ones have learned, until another operator's begin."""
    held, key = kept.of("encoder"), (path, spaced)
    if key not in held:
        held[key] = Encoder(path, spaced)
    return held[key]
