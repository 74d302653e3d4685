"""Token ids of whole texts by the tokenizers library, word by word.

A tokenizer whose pre-tokenizer drops white space and never joins characters across it gives a text the ids of
its blank-separated words, one after the other. Each distinct word of a batch is therefore encoded once by the
library, and up to ``remembered`` words of late are remembered per Python worker: those met again stay. For other tokenizers pass ``by_word=False``.
"""

from __future__ import annotations

import json
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstay.llm.storage import map_arrow
from fieldstay.llm.words import batches_of, plain, split_words

# Words remembered per worker, by a caller that shares it with other steps; alone a worker has room for more.
REMEMBERED, REMEMBERED_ALONE = 300_000, 1_000_000
TAIL = b".,;:!?"
# Unknown words handed to the library in one text.
JOINED = 2_000

_encoders: dict = {}


class Encoder:
    def __init__(self, path: str, end_id: int | None, by_word: bool, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        text = Path(path).read_text(encoding="utf-8")
        self.tokenizer = Tokenizer.from_str(text)
        self.end = [] if end_id is None else [end_id]
        self.by_word = by_word
        # Letters may be folded first where the normaliser folds them anyway; special tokens are told apart by case.
        self.folds = '"Lowercase"' in json.dumps(json.loads(text).get("normalizer"))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = json.loads(text)["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocab.values(), default=0) + 1, bool)
        if suffix:
            self.ends_word[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        # Words of late, and those from before that: a word that is met again in time stays.
        self.memory: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        self.half = remembered // 2
        vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if max([vocabulary - 1, *self.end]) < 1 << 16 else 4

    def _singly(self, words: list[str]) -> list[bytes]:
        out = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in out]

    def _library(self, words: list[str]) -> list[bytes]:
        """The ids of each word. Words of letters are encoded joined by blanks: each is one piece, and the last id of
        a piece is one that ends a word, so as many such ids as words tell them apart."""
        out: dict[str, bytes] = {}
        letters = [w for w in words if w.isalpha()] if self.ends_word.any() else []
        for i in range(0, len(letters), JOINED):
            chunk = letters[i : i + JOINED]
            ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(chunk)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(chunk) and ends[-1] == len(ids):
                data, bounds = ids.tobytes(), (4 * ends).tolist()
                out.update(zip(chunk, (data[a:b] for a, b in zip([0, *bounds], bounds)), strict=False))
        rest = [w for w in words if w not in out]
        out.update(zip(rest, self._singly(rest), strict=True))
        return [out[w] for w in words]

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """The ids of each distinct word as little-endian bytes."""
        if len(self.memory) + len(words) > self.half:
            self.memory, self.earlier = {}, self.memory
        memory, earlier = self.memory, self.earlier
        out = list(map(memory.get, words))
        holes = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            out[i] = earlier.get(words[i])
            if out[i] is None:
                holes.append(i)
            else:
                memory[words[i]] = out[i]
        missing, split = {}, {}
        for i in holes:
            # ASCII letters and the punctuation behind them are separate pieces for the pre-tokenizer.
            core = words[i].rstrip(TAIL)
            if len(core) < len(words[i]) and core.isalpha():
                split[i] = (core, words[i][len(core) :])
            for part in split.get(i, (words[i],)):
                if part not in memory:
                    missing[part] = None
        memory.update(zip(missing, self._library([w.decode() for w in missing]), strict=True))
        for i in holes:
            if i in split:
                memory[words[i]] = memory[split[i][0]] + memory[split[i][1]]
            out[i] = memory[words[i]]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: unsigned 32-bit ids of all texts, end ids included; text i's from ``offsets[i]``."""
        texts = pc.fill_null(plain(texts), "")
        n = len(texts)
        if not self.by_word:
            lists = [e.ids + self.end for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            return np.concatenate([np.zeros(0, "<u4"), *(np.asarray(x, "<u4") for x in lists)]).astype("<u4"), offsets
        if self.folds and not any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special):
            texts = pc.ascii_lower(texts)
        words = split_words(texts)
        ids = self._ids_of(words.values.cast(pa.binary()).to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        # One more "word" ends each text.
        table = np.frombuffer(b"".join([*ids, np.asarray(self.end, "<u4").tobytes()]), "<u4")
        sizes = np.append(sizes, len(self.end))
        first = np.cumsum(sizes) - sizes
        codes = np.insert(words.codes.astype(np.int64), words.offsets[1:], len(ids))
        counts = sizes[codes]
        ends = np.cumsum(counts)
        flat = table[np.repeat(first[codes] - (ends - counts), counts) + np.arange(ends[-1] if n else 0)]
        offsets = np.concatenate([[0], ends])[words.offsets + np.arange(n + 1)].astype(np.int64)
        return flat, offsets


def encoder(path: str, end_id: int | None, by_word: bool, remembered: int = REMEMBERED) -> Encoder:
    key = (path, end_id, by_word, remembered)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def binary_slices(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Slices of ``ids`` as binary values: little-endian unsigned 32-bit numbers."""
    data = np.ascontiguousarray(ids, "<u4")
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(data)]
    )


def token_pieces(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 1,
    longest: int | None = None, by_word: bool = True, remembered: int = REMEMBERED,
) -> DataFrame:
    """``(id, doc_tokens, start, length, ids)``: the token ids of every whole text (null: empty), in pieces of at
    most ``longest`` ids. ``ids`` is binary, little-endian unsigned 32-bit numbers. Each document ends with
    ``end_id``. A document without any id has no row; a null id is kept; other columns are not carried.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        coder = encoder(tokenizer, end_id, by_word, remembered)
        for whole in batches:
            for batch in batches_of(whole, "text", 1 << 22):
                ids, offsets = coder.encode(batch.column(1))
                totals = np.diff(offsets)
                step = longest or max(1, int(totals.max(initial=1)))
                pieces = -(-totals // step)
                owner = np.repeat(np.arange(len(totals)), pieces)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * step
                length = np.minimum(step, totals[owner] - start)
                bounds = np.concatenate([[0], np.cumsum(length)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner)),
                        pa.array(totals[owner].astype(np.int64)),
                        pa.array(start.astype(np.int64)),
                        pa.array(length.astype(np.int64)),
                        binary_slices(ids, bounds),
                    ],
                    names=["id", "doc_tokens", "start", "length", "ids"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, f"id {id_type}, doc_tokens long, start long, length long, ids binary")
