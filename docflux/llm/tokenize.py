"""The whole corpus as ids of a public byte-level BPE vocabulary, through a SentencePiece model made from it.

The rank file of a byte-level BPE is serialised as a SentencePiece BPE model: each token's bytes are written as printable
characters (one a byte), its score is the negative rank, and the normaliser is the identity. SentencePiece then merges the
pair of the best score first, which is the pair of the lowest rank. Texts are split by the vocabulary's own pattern, each
distinct pre-token is encoded once a task, and decoding maps the characters back to bytes.

Nulls and empty texts give an empty list; a blank text is encoded as it stands; special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflux.session import spread

#: Where the vocabulary files lie; a parameter of every function here.
TOKENIZER_DIR = os.environ.get("DOCFLUX_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k"
#: The public vocabulary's split pattern, with \s written as the property it stands for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Distinct pre-tokens that a Python worker keeps; beyond it the cache starts anew (memory only, results are the same).
CACHE_ENTRIES = 200_000


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[int, str]:
    """A printable character for each byte: itself where printable in Latin-1, else the next free one from U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def rank_file(name: str, folder: str) -> bytes:
    """A vocabulary's rank file: about a megabyte, read on the driver only."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return f.read()


def read_ranks(data: bytes) -> list[bytes]:
    """The tokens of a rank file in order of rank."""
    pairs = [line.split() for line in data.splitlines() if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def model_proto(tokens: list[bytes]) -> bytes:
    """A serialised SentencePiece BPE model whose piece ids are the tokens' ranks; the last id is the unknown piece."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    alphabet = byte_alphabet()
    model = pb.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece="".join(alphabet[b] for b in token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.unk_id = len(tokens)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encoder and decoder of one vocabulary, one a Python worker."""

    def __init__(self, name: str = VOCABULARY, folder: str = TOKENIZER_DIR, data: bytes | None = None):
        self.tokens = read_ranks(rank_file(name, folder) if data is None else data)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.tokens))
        self.split = regex.compile(PATTERN).findall
        self.table = {b: c for b, c in byte_alphabet().items()}
        self.cache: dict[str, tuple[int, ...]] = {}

    def _learn(self, missing: list[str]) -> None:
        table = self.table
        mapped = [x.encode("utf-8").decode("latin-1").translate(table) for x in missing]
        self.cache.update(zip(missing, map(tuple, self.model.encode(mapped, num_threads=1))))

    def pieces(self, text: str) -> list[tuple[int, ...]]:
        """The ids of each pre-token of ``text``."""
        parts = self.split(text)
        cache = self.cache
        try:
            return [cache[x] for x in parts]
        except KeyError:
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
            self._learn([x for x in dict.fromkeys(parts) if x not in cache])
            return [cache[x] for x in parts]

    def encode(self, text: str | None) -> list[int]:
        """The ids of ``text``; an empty list for None and ''."""
        return list(chain.from_iterable(self.pieces(text))) if text else []

    def count(self, text: str | None) -> int:
        """How many ids ``encode`` gives."""
        return sum(map(len, self.pieces(text))) if text else 0

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``; bytes that are no valid UTF-8 become U+FFFD."""
        back = {c: b for b, c in self.table.items()}
        pieces = (self.model.id_to_piece(int(i)) for i in ids)
        return bytes(back[c] for piece in pieces for c in piece).decode("utf-8", errors="replace")


_CODECS: dict[str, Codec] = {}


def codec(shipped: Broadcast) -> Codec:
    """The worker's codec of a broadcast (digest, rank file), kept for all tasks of that worker."""
    digest, data = shipped.value
    if digest not in _CODECS:
        _CODECS[digest] = Codec(data=data)
    return _CODECS[digest]


def ship(spark: SparkSession, name: str, folder: str) -> Broadcast:
    """A vocabulary for the workers: executors need no copy of the folder."""
    data = rank_file(name, folder)
    return spark.sparkContext.broadcast((hashlib.md5(data).hexdigest(), data))


def _batches(text: str, shipped: Broadcast, make: Callable[[Codec, list], pa.Array], out: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shipped)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            keep = [i for i in range(batch.num_columns) if i != at]
            columns = [*(batch.column(i) for i in keep), make(own, batch.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[i] for i in keep), out])

    return run


def _ids(own: Codec, texts: list) -> pa.Array:
    offsets, values = np.zeros(len(texts) + 1, np.int32), []
    for i, text in enumerate(texts):
        ids = own.encode(text)
        values.append(np.array(ids, np.int32))
        offsets[i + 1] = offsets[i] + len(ids)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _counts(own: Codec, texts: list) -> pa.Array:
    return pa.array([own.count(x) for x in texts], pa.int64())


def encode_corpus(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY, folder: str = TOKENIZER_DIR) -> DataFrame:
    """(key, ids): one row a row of ``docs``, ids without special tokens. No shuffle unless the scan has too few splits."""
    rows = spread(docs.select(key, F.col(text).alias("_text")))
    return rows.mapInArrow(_batches("_text", ship(docs.sparkSession, vocabulary, folder), _ids, "ids"), f"`{key}` {dict(rows.dtypes)[key]}, ids array<int>")


def count_tokens(docs: DataFrame, text: str, keys: list[str], vocabulary: str = VOCABULARY, folder: str = TOKENIZER_DIR) -> DataFrame:
    """(keys..., n_tokens bigint): as encode_corpus, but only the number of ids, so that no list leaves the worker."""
    rows = spread(docs.select(*keys, F.col(text).alias("_text")))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_batches("_text", ship(docs.sparkSession, vocabulary, folder), _counts, "n_tokens"), ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n_tokens bigint")
