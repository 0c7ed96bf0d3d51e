"""Token ids of whole texts, by the tokenizers library, word by word.

The tokenizer drops white space and never joins what white space parts, so a
text's ids are those of its words, end to end.  A batch's words are split and
made distinct by Arrow; only distinct words that a worker has not met are
encoded, in one go: the library's normalizer over all of them, its split
pattern, and its model once per piece.  Words with characters beyond
Latin, or with a special token in them, are encoded by the tokenizer as they are.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from isobar.llm.common import arrow_map

#: Name of a public tokenizer's file, or its path.
TOKENIZER = "word_bpe_49k.json"
#: Id that ends every document.
END = 1
#: Words, and pieces of words, that a worker remembers, and the words' bytes.
KNOWN, HELD = 1 << 20, 16 << 20
#: New words encoded in one go.
LEARN = 1 << 16
#: Bytes of text taken at a time (one word at least).
PIECE = 4 << 20
_SPACE = re.compile(rb"[\t-\r ]").search
#: Characters on whose classes all pattern engines agree.
_LATIN = re.compile("[!-~¡-ɏ]+").fullmatch


class Words:
    """Ids of single words, as bytes of little-endian 32-bit numbers."""

    def __init__(self, name: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if not os.path.exists(name):
            import public_tokenizers
            name = public_tokenizers.path(name)
        self.whole, self.known, self.parts, self.held = Tokenizer.from_file(name), {}, {}, 0
        form = json.loads(self.whole.to_str())
        steps = (form.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = steps[0] if [s["type"] for s in steps] == ["Split", "ByteLevel"] else {}
        plain = split.get("behavior") == "Removed" and split.get("invert") and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
        self.pattern = regex.compile(split["pattern"]["Regex"]) if plain and self.whole.normalizer else None
        self.to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = [t["content"].lower() for t in form["added_tokens"]]

    def _pieces(self, distinct: list[str]) -> None:
        """Ids of pieces not met before."""
        symbols = self.to_bytes.pre_tokenize_str(" ".join(distinct))[0][0].split("Ġ")
        tokenize = self.whole.model.tokenize
        for p, s in zip(distinct, symbols):
            self.parts[p] = array("I", [t.id for t in tokenize(s)]).tobytes()

    def _learn(self, words: list[bytes]) -> None:
        text = b" ".join(words).decode().split(" ")
        if self.pattern is None:
            fast, slow = [], range(len(text))
        elif _LATIN(joined := "".join(text)) and not any(s in joined.lower() for s in self.special):
            # the normalizer makes one blank of two: an empty word between others would vanish and shift all behind it
            fast, slow = [i for i, w in enumerate(text) if w], [i for i, w in enumerate(text) if not w]
        else:
            fast = [i for i, w in enumerate(text) if _LATIN(w) and not any(s in w.lower() for s in self.special)]
            slow = sorted(set(range(len(text))) - set(fast))
        norm = self.whole.normalizer.normalize_str(" ".join([text[i] for i in fast])).split(" ") if fast else []
        split = self.pattern.findall if fast else None
        cut = [(w,) if w.isalpha() else split(w) for w in norm]
        parts = self.parts
        if new := list(dict.fromkeys([p for x in cut for p in x if p not in parts])):
            self._pieces(new)
        for i, x in zip(fast, cut):
            self.known[words[i]] = parts[x[0]] if len(x) == 1 else b"".join([parts[p] for p in x])
        for i in slow:
            self.known[words[i]] = array("I", self.whole.encode(text[i], add_special_tokens=False).ids).tobytes()

    def ids(self, words: list[bytes]) -> list[bytes]:
        if max(len(self.known), len(self.parts)) > KNOWN or self.held > HELD:
            self.known, self.parts, self.held = {}, {}, 0
        found = list(map(self.known.get, words))
        if new := [w for w, x in zip(words, found) if x is None]:
            for k in range(0, len(new), LEARN):
                self._learn(new[k:k + LEARN])
            self.held += sum(map(len, new))
            found = [self.known[w] if x is None else x for w, x in zip(words, found)]
        return found


_WORDS: dict[str, Words] = {}


def worker_words(name: str) -> Words:
    """The worker's own, kept from task to task."""
    if name not in _WORDS:
        _WORDS[name] = Words(name)
    return _WORDS[name]


def _runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts, those over ``PIECE`` bytes cut at white space, and whether a text ends there."""
    if not len(texts):
        return texts, np.ones(0, bool)
    _, offsets, data = texts.buffers()
    offsets, of, cuts = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1], [], []
    for i in np.flatnonzero(np.diff(offsets) > PIECE).tolist():
        at, end = offsets[i:i + 2].tolist()
        while end - at > PIECE and (space := _SPACE(data, at + PIECE, end)):
            at = space.start()
            of.append(i)
            cuts.append(at)
    last = np.insert(np.ones(len(texts), bool), of, False)
    offsets = np.insert(offsets, [i + 1 for i in of], cuts)
    return pa.LargeStringArray.from_buffers(len(last), pa.py_buffer(offsets), data), last


def encoded(words: Words, texts: pa.Array) -> Iterator[np.ndarray]:
    """The ids of every text (null: empty), with END behind them."""
    texts, last = _runs(pc.fill_null(texts.cast(pa.large_string()), ""))
    part: list[np.ndarray] = []  # of a text that goes on
    size = np.r_[0, np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))]
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(size, size[a] + PIECE, side="right")) - 1)
        split = pc.ascii_split_whitespace(texts.slice(a, b - a))
        flat = split.flatten().dictionary_encode()
        each = pa.array(words.ids(flat.dictionary.cast(pa.large_binary()).to_pylist()), pa.large_binary())
        spelt = each.take(flat.indices)  # ids end to end, as bytes
        ids, end = np.frombuffer(b"", "<u4"), np.zeros(1, np.int64)
        if len(spelt):
            _, offsets, data = spelt.buffers()
            end = np.frombuffer(offsets, np.int64)[:len(spelt) + 1] // 4
            ids = np.frombuffer(data, "<u4", count=int(end[-1])) if data is not None else ids
        at = end[np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]]
        for i in range(b - a):
            part.append(ids[at[i]:at[i + 1]])
            if last[a + i]:
                yield np.concatenate([*part, np.array([END], "<u4")])
                part = []
        a = b


def pieces(docs: DataFrame, capacity: int, tokenizer: str = TOKENIZER, keep_ids: bool = False) -> DataFrame:
    """row, doc_id, piece, start, length, ids_crc32 and, if asked for, ids: documents cut at ``capacity`` tokens.

    ``row`` numbers the pieces, so that equal ones stay apart.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = worker_words(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            of, found, ids = [], [], []
            for i, x in enumerate(encoded(words, batch.column("text"))):
                for piece, start in enumerate(range(0, len(x), capacity)):
                    part = x[start:start + capacity]
                    of.append(i)
                    found.append((row, piece, start, len(part), zlib.crc32(part.tobytes())))
                    row += 1
                    if keep_ids:
                        ids.append(part.astype(np.int32))
            columns = list(zip(*found)) or [()] * 5
            out = {"row": pa.array(columns[0], pa.int64()), "doc_id": batch.column("doc_id").take(pa.array(of, pa.int64())),
                   "piece": pa.array(columns[1], pa.int32())}
            out |= {c: pa.array(x, pa.int64()) for c, x in zip(("start", "length", "ids_crc32"), columns[2:])}
            if keep_ids:
                out["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    return arrow_map(docs.select("doc_id", "text"), cut, f"row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long"
                     + (", ids array<int>" if keep_ids else ""))
