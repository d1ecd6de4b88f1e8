"""Whole-text encoding with the tokenizers library inside Arrow batches.

A space that follows a character other than white space always starts a new
pre-token (the pre-token patterns look ahead, never behind, and no match has
white space after other characters), so a text may be cut there and the ids
of the pieces concatenated.  Each worker keeps the ids of pieces it has seen
and hands the library only new ones.  Arrow cuts a group of texts and numbers
its distinct pieces, so the table is asked once per distinct piece of a group
and the ids of the texts are one gather.  A text for which the cut is not
proven (a piece that is empty or ends with white space, a special string,
U+0000) goes to the library whole.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_CHARS = 1 << 22

_ENCODERS: dict[tuple[str, int], "PieceEncoder"] = {}


def encoder(path: str, max_pieces: int = 1_200_000) -> "PieceEncoder":
    """One encoder per Python worker, kept between tasks."""
    key = (path, max_pieces)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, max_pieces)
    return _ENCODERS[key]


class PieceEncoder:
    """``max_pieces`` bounds the memory of the piece table (about 200 bytes
    each); a full table drops the pieces met in the fewest groups, which
    changes speed and nothing else."""

    def __init__(self, path: str, max_pieces: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2") if self.lib.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.max_pieces = max_pieces
        self.bytes_of = self._bytes_of_ids()
        self.table: dict[str, int] = {}  # the place of a piece, in order, in the arrays below
        self.ids = np.zeros(0, self.dtype)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int32)  # -1: no ids of its own
        self.met = np.zeros(0, np.int32)  # groups

    def whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, packed as ``self.dtype``."""
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= GROUP_CHARS:
                out += self._encode(group)
                group, size = [], 0
        return out + self._encode(group)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        if len(self.table) > self.max_pieces:
            self._make_room()
        whole = {i for i, t in enumerate(texts) if "\0" in t or any(s in t for s in self.specials)}
        marked = ["\0" if i in whole else "\0" + t for i, t in enumerate(texts)]
        cut = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        pieces = cut.flatten().dictionary_encode()
        first = cut.offsets.to_numpy()
        at = self._places(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
        sizes = self.sizes[at]
        whole.update((np.searchsorted(first, np.flatnonzero(sizes < 0), side="right") - 1).tolist())
        np.maximum(sizes, 0, out=sizes)
        ids, ends = self._gather(at, sizes)
        raw, bounds = ids.tobytes(), (np.concatenate([[0], ends])[first] * self.dtype.itemsize).tolist()
        return [self.whole(t) if i in whole else raw[a:b] for i, (t, a, b) in enumerate(zip(texts, bounds, bounds[1:]))]

    def _gather(self, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces at these places one after another, their ends)."""
        ends = np.cumsum(sizes, dtype=np.int64)
        take = np.repeat(self.starts[at] - ends + sizes, sizes)
        take += np.arange(len(take))
        return self.ids[take], ends

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Places in the table of distinct pieces; new ones are learnt."""
        at = np.fromiter(map(self.table.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            known = len(self.table)
            self._learn([pieces[i] for i in missing.tolist()])
            at[missing] = np.arange(known, len(self.table))
        self.met[at] += 1
        return at

    def _make_room(self) -> None:
        least = 2
        while np.count_nonzero(self.met >= least) > self.max_pieces // 2:
            least *= 2
        keep = self.met >= least
        at = np.flatnonzero(keep)
        self.table = {p: i for i, p in enumerate(p for p, k in zip(self.table, keep.tolist()) if k)}
        sizes = self.sizes[at]
        self.ids, ends = self._gather(at, np.maximum(sizes, 0))
        self.starts, self.sizes, self.met = ends - np.maximum(sizes, 0), sizes, self.met[at] // 2

    def _learn(self, new: list[str]) -> None:
        starts, sizes = np.zeros(len(new), np.int64), np.full(len(new), -1, np.int32)
        parts, end, inner = [self.ids], len(self.ids), []
        for i, p in enumerate(new):
            if p[:1] == "\0":
                if not p[-1].isspace():  # the mark alone: no ids
                    ids = np.frombuffer(self.whole(p[1:]), self.dtype)
                    starts[i], sizes[i] = end, len(ids)
                    parts.append(ids)
                    end += len(ids)
            elif p and not p[-1].isspace():
                inner.append(i)
        for k in range(0, len(inner), 512):
            some = inner[k : k + 512]
            ids, cuts = self._ids_joined([new[i] for i in some])
            starts[some], sizes[some] = end + cuts[:-1], np.diff(cuts)
            parts.append(ids)
            end += len(ids)
        known = len(self.table)
        self.table.update(zip(new, range(known, known + len(new))))
        self.ids = np.concatenate(parts)
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])

    def _ids_joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of " piece" for many pieces by one call; the bytes or the
        offsets of the ids tell the pieces apart."""
        text = " " + " ".join(pieces)
        if self.bytes_of is None:
            got = self.lib.encode(text, add_special_tokens=False)
            ids = np.array(got.ids, self.dtype)
            at = np.fromiter((o[0] for o in got.offsets), np.int64, len(ids))
            starts = np.cumsum([0] + [len(p) + 1 for p in pieces])
        else:
            ids = np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            size = self.bytes_of[ids]
            at = np.cumsum(size) - size
            starts = np.cumsum([0] + [len(p.encode()) + 1 for p in pieces])
        return ids, np.searchsorted(at, starts)

    def _bytes_of_ids(self) -> np.ndarray | None:
        """Bytes that each id stands for, if every byte of a text is in its
        ids: a byte-level vocabulary spells each byte as one character."""
        sizes = np.zeros(self.lib.get_vocab_size(), np.int64)
        for token, i in self.lib.get_vocab().items():
            sizes[i] = len(token)
        for i, token in self.lib.get_added_tokens_decoder().items():
            sizes[i] = len(token.content.encode())
        sample = " Some words,\n\ttabs  and 'll 1234 \u00e9e\u0301 \u4e2d\u6587 \U0001f600\x00\x85 A!"
        ids = self.lib.encode(sample, add_special_tokens=False).ids
        return sizes if self.lib.normalizer is None and sizes[ids].sum() == len(sample.encode()) else None
