"""Encoding of whole texts with a byte-level BPE tokenizer file, fast for text with recurring words.

A byte-level BPE splits text into pre-tokens that never depend on one another. A single space or line feed between two
characters that aren't white space always starts a pre-token, and so does a full stop or comma after a letter. A text
may be cut there and each piece encoded on its own; pieces recur, so their ids are kept in a bounded dictionary. Texts
with runs of white space, with other white space next to a cut, or with the string of an added token go to the tokenizer
as a whole. Both ways give the ids of ``Tokenizer.encode``: the string of a special token in a text becomes its id.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

CACHE = 800_000
CHUNK = 128
BATCH_CHARS = 4_000_000
#: No id: vocabularies have fewer than 2**31 entries, so this never occurs in the bytes of ids.
NOT_APART = b"\xff" * 4


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer

        self.np = np
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        #: Strings that the library looks for in the text before it splits it; those with white space may span pieces.
        added = [t.content for t in self.tok.get_added_tokens_decoder().values() if t.content]
        self.added = [t for t in added if not any(c.isspace() for c in t)]
        self.spanning = [t for t in added if t not in self.added]
        self.opens = {}
        for first, mark in (("Ġ", " "), ("Ċ", "\n")):
            self.opens[mark] = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
            self.opens[mark][[i for t, i in vocab.items() if t.startswith(first)]] = True
        self.size = max(vocab.values(), default=0) + 1
        self.memo: dict[str, bytes] = {}
        self.points = dict(zip(".,", self.whole([".", ","])))

    def whole(self, texts: list[str]) -> list[bytes]:
        np = self.np
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        """Put the ids of each piece, after its space or with its line feed, into the dictionary.

        Pieces that may not be cut off get NOT_APART.
        """
        memo, points = self.memo, self.points
        seen = "\n".join(words)
        held = {w for t in self.added if t in seen for w in words if t in w}
        if held:
            memo.update(dict.fromkeys(held, NOT_APART))
            words = [w for w in words if w not in held]
        inner = [w for w in words if w.isalpha()]
        lines, ended = [], []
        for w in [w for w in words if not w.isalpha()]:
            if not w or w[-1].isspace():
                memo[w] = NOT_APART
            elif w[0] == "\n":
                if w[1].isspace():
                    memo[w] = NOT_APART
                else:
                    lines.append(w)
            elif w[0].isspace():
                memo[w] = NOT_APART
            elif w[-1] in points and w[:-1].isalpha():
                ended.append(w)
            else:
                inner.append(w)
        self.join("\n", lines)
        self.join(" ", list({*inner, *(c for w in ended if (c := w[:-1]) not in memo)}))
        for w in ended:
            memo[w] = memo[w[:-1]] + points[w[-1]]

    def join(self, mark: str, words: list[str]) -> None:
        """Learn words that follow ``mark`` by encoding many as one text: only first tokens start with the mark."""
        if not words:
            return
        np, memo, opens = self.np, self.memo, self.opens[mark]
        chunks = [words[i : i + CHUNK] for i in range(0, len(words), CHUNK)]
        wholes = [" " + " ".join(c) if mark == " " else "".join(c) for c in chunks]
        parts = [np.array(e.ids, dtype="<u4") for e in self.tok.encode_batch_fast(wholes, add_special_tokens=False)]
        ids = np.concatenate(parts)
        starts = np.flatnonzero(opens[ids])
        if len(starts) == len(words) and all(np.count_nonzero(opens[p]) == len(c) and opens[p[0]] for p, c in zip(parts, chunks)):
            raw, edges = ids.tobytes(), (4 * np.append(starts, len(ids))).tolist()
            memo.update(zip(words, [raw[a:b] for a, b in zip(edges, edges[1:])]))
        else:
            memo.update(zip(words, self.whole([w if mark == "\n" else " " + w for w in words])))

    def encode(self, texts) -> list[bytes]:
        """Ids of each text of an Arrow array, as little-endian unsigned 32-bit integers; null is empty.

        Arrow splits the texts and numbers their distinct pieces; Python looks at each distinct piece once.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        np = self.np
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # strings, several times as fast as to_pylist
        memo = self.memo
        new = [w for w in words if w not in memo]
        if len(memo) + len(new) > CACHE:
            memo.clear()
            new = words
        self.learn(new)
        ids = pa.array([memo[w] for w in words], pa.binary()).take(coded.indices)
        offsets, data = np.frombuffer(ids.buffers()[1], dtype=np.int32), memoryview(ids.buffers()[2] or b"")
        firsts = coded.dictionary.take(coded.indices.take(pa.array(bounds[:-1]))).to_pylist()
        after, ends = offsets[bounds[:-1] + 1].tolist(), offsets[bounds[1:]].tolist()
        spanned = {i for t in self.spanning for i in np.flatnonzero(pc.match_substring(texts, t).to_numpy(zero_copy_only=False)).tolist()}
        out, odd = [], []
        for i, (p, first, a, b) in enumerate(zip(firsts, self.whole(firsts), after, ends)):
            raw = first + data[a:b]
            if i in spanned or bounds[i + 1] - bounds[i] > 1 and (not p or p[-1].isspace() or NOT_APART in raw or any(t in p for t in self.added)):
                odd.append(i)
            out.append(raw)
        if odd:
            for i, raw in zip(odd, self.whole(texts.take(pa.array(odd)).to_pylist())):
                out[i] = raw
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary file."""
    return Encoder(path)


def encoded(path: str, batches: Iterator, end_id: int | None) -> Iterator[tuple[object, bytes]]:
    """(doc_id, ids with the end id) of the rows (doc_id, text) of Arrow batches, in order.

    Works on runs of rows of about BATCH_CHARS bytes, so batches of very long texts need no more memory.
    """
    import pyarrow.compute as pc

    enc, tail = encoder(path), b"" if end_id is None else end_id.to_bytes(4, "little")

    def run(batch, start, stop):
        some = batch.slice(start, stop - start)
        return zip(some.column("doc_id").to_pylist(), [raw + tail for raw in enc.encode(some.column("text"))])

    try:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            start = held = 0
            for i, n in enumerate(sizes):
                if i > start and held + n > BATCH_CHARS:
                    yield from run(batch, start, i)
                    start, held = i, 0
                held += n
            if start < batch.num_rows:
                yield from run(batch, start, batch.num_rows)
    finally:
        enc.memo.clear()  # the worker lives on, idle, and other tasks of its executor need the memory
