"""Op 9, SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed, and normaliser, metaspace marker, vocabulary
with scores and byte fallback are rebuilt as a ``tokenizers`` pipeline.
Unigram models keep their scores; BPE models, whose scores are merge ranks, get
the merges that the ranks imply.  Whole texts are encoded in batches on the
library's threads, and these are the ids that are returned.  The sentencepiece
library encodes each whole text too, and a row says whether it gives the same
ids.

Defined cases: a null text counts as empty and has no ids; a null id is kept;
repeated rows give repeated results; further columns are ignored; an empty
table gives an empty result.  Characters that the model cannot hold (U+2581,
which stands for the space) come back as spaces, as in the library.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, table, text_batches, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Threads of the tokenizers library in a task's worker, unless RAYON_NUM_THREADS says otherwise: it takes all cores of a machine by itself, which its tasks share.
THREADS = 2
#: SentencePiece's marker for a space, and its piece types (fixed values of the format).
SPACE_MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _merges(pieces: dict[str, tuple[int, float]]) -> list[tuple[str, str]]:
    """Every split of a piece into two pieces, best score first, as the library merges pairs."""
    ranked = []
    for piece, (at, score) in pieces.items():
        for k in range(1, len(piece)):
            if piece[:k] in pieces and piece[k:] in pieces:
                ranked.append((-score, at, pieces[piece[:k]][0], pieces[piece[k:]][0], piece[:k], piece[k:]))
    return [x[4:] for x in sorted(ranked)]


def build(model: bytes):
    """A tokenizers.Tokenizer that encodes and decodes as the SentencePiece model does."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    proto = pb.ModelProto.FromString(model)
    trainer, norm = proto.trainer_spec, proto.normalizer_spec
    usable = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED)}
    unknown = next((i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN), None)
    if trainer.treat_whitespace_as_suffix or any(p.type == USER_DEFINED for p in proto.pieces):
        raise ValueError("models with user-defined pieces or suffix markers are not supported")
    if trainer.model_type == UNIGRAM:
        # Pieces that may not match text keep their id under a string that no normalised text holds.
        vocab = [(p.piece if p.type in (NORMAL, UNKNOWN, BYTE) else f"{i}", p.score) for i, p in enumerate(proto.pieces)]
        backend = models.Unigram(vocab, unk_id=unknown, byte_fallback=trainer.byte_fallback)
    elif trainer.model_type == BPE:
        backend = models.BPE(
            {p.piece: i for i, p in enumerate(proto.pieces)},
            _merges(usable),
            unk_token=None if unknown is None else proto.pieces[unknown].piece,
            fuse_unk=True,
            byte_fallback=trainer.byte_fallback,
        )
    else:
        raise ValueError(f"model type {trainer.model_type} is not supported")
    tok = Tokenizer(backend)
    steps = [normalizers.Precompiled(norm.precompiled_charsmap)] if norm.precompiled_charsmap else []
    if norm.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(" +"), " "), normalizers.Strip()]
    if norm.add_dummy_prefix:
        steps.append(normalizers.Prepend(SPACE_MARK))
    if norm.escape_whitespaces:
        steps.append(normalizers.Replace(" ", SPACE_MARK))
    tok.normalizer = normalizers.Sequence(steps)
    tok.decoder = decoders.Sequence([
        decoders.Replace(SPACE_MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
        *([decoders.Strip(" ", 1, 0)] if norm.add_dummy_prefix else []),
    ])
    return tok


class Codec:
    """The rebuilt tokenizer, and the library's own beside it for parity."""

    def __init__(self, model: bytes):
        import os

        import numpy as np
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        self.np, self.tok, self.plain = np, build(model), sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = pb.ModelProto.FromString(model)
        self.strips = proto.normalizer_spec.add_dummy_prefix
        self.bytes_of = pa.array([bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type == CONTROL else proto.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else p.piece.replace(SPACE_MARK, " ").encode() for p in proto.pieces], pa.binary())

    def encode(self, given: list[str]) -> tuple[list[list[int]], list[bool]]:
        """The ids of each text, and whether the sentencepiece library gives the same."""
        coded = [x.ids for x in self.tok.encode_batch_fast(given, add_special_tokens=False)]
        return coded, [x == y for x, y in zip(coded, self.plain.encode(given, num_threads=1), strict=True)]

    def decode(self, coded: list[list[int]]) -> list[str]:
        """The pieces' bytes put together; ill-formed bytes become U+FFFD.

        These are the texts of the backend's own decoder (tested), for a tenth of its time.
        """
        np = self.np
        flat = np.concatenate([np.array(x, np.int32) for x in coded] or [np.zeros(0, np.int32)])
        taken = self.bytes_of.take(pa.array(flat))
        starts, raw = np.frombuffer(taken.buffers()[1], np.int32)[: len(flat) + 1], taken.buffers()[2]
        raw, at, out = (raw.to_pybytes() if raw else b""), 0, []
        for x in coded:
            piece = raw[starts[at] : starts[at + len(x)]] if x else b""
            at += len(x)
            out.append((piece[1:] if self.strips and piece[:1] == b" " else piece).decode("utf-8", "replace"))
        return out


def encode(df: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), ids: bool = True) -> DataFrame:
    """id, kept columns, n_tokens, token_ids (unless ids is false), token_sha256, parity, round_trip.

    token_sha256 is that of the ids as little-endian 32-bit words.  parity: the
    sentencepiece library gives these ids too.  round_trip: the decoded ids are the text.
    """
    with open(model, "rb") as f:
        raw = df.sparkSession.sparkContext.broadcast(f.read())
    kept = [df.schema[c] for c in (id_col, *keep)]

    def run(batches):
        import hashlib

        codec = Codec(raw.value)
        for batch in batches:
            for b in blocks(batch, "__text"):
                given = texts(b, "__text")
                coded, same = codec.encode(given)
                back = codec.decode(coded)
                cols = [*b.columns[: len(kept)], pa.array([len(x) for x in coded], pa.int64())]
                packed = [codec.np.array(x, "<i4") for x in coded]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(codec.np.cumsum([0, *map(len, packed)]), pa.int32()), pa.array(codec.np.concatenate(packed), pa.int32())))
                cols += [
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in packed]),
                    pa.array(same), pa.array([x == y for x, y in zip(given, back, strict=True)]),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names = [*(f.name for f in kept), "n_tokens", *["token_ids"] * ids, "token_sha256", "parity", "round_trip"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_tokens long", *["token_ids array<int>"] * ids, "token_sha256 string", "parity boolean", "round_trip boolean"])
    return text_batches(df.select(*[F.col(f.name) for f in kept], F.col(text_col).alias("__text"))).mapInArrow(run, schema)


def decode(df: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """id, text: the ids decoded; null ids give an empty text."""
    with open(model, "rb") as f:
        raw = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        codec = Codec(raw.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codec.decode([x or [] for x in b.column(1).to_pylist()]), pa.string())], names=["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
