"""SentencePiece encoding and decoding with a distinct-chunk table.

The text is marked as the library marks it: U+2581 in front and for every space. Where
no piece of the model has a mark after another character, and the normaliser changes
nothing else, no piece crosses from a word to the next mark. Then a chunk, marks and
the characters up to the next mark, has the same ids wherever it stands.

The marked words of all texts are counted, and those that occur more than once, the
most frequent ``TABLE`` of them, make the table: each is segmented once, by the library,
in whatever task it falls to. The table's size is bounded by its rows and the length of
their words, so it is broadcast, and ids are joined back by position where the texts
lie. A chunk beyond the table (a word of one occurrence, a run of spaces) is segmented
in place, once for each step of ``wordhash.STEP`` characters. A shuffled join by
position would ship every text and every position instead. A model without that
property of chunks is used on whole texts.

Memory is bounded by the step: a step's texts are encoded, decoded, put into one Arrow
batch and sent on before the next is begun. Rows that repeat the text of the row before
(as a mix writes them) are encoded once.

Defined cases: null text counts as ''; the empty text has begin and end ids only; texts
of any length are one row; repeated rows have a row each; other columns are kept by
:func:`encode`, but for those named like a result, which the result replaces. An empty
table gives an empty table.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, others
from .wordhash import in_steps

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
#: Words in the table at most, and characters in one of them.
TABLE, LONGEST = 2**17, 24


def chunks_are_independent(sp) -> bool:
    """No piece crosses into a mark, and the normaliser only marks spaces."""
    crossing = any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size()))
    probe = "  Aﬁ① 　\tx́\n é ａ  ​\x01 "
    plain = "".join(sp.id_to_piece(i) if not sp.is_byte(i) else "" for i in sp.encode(" a  b "))
    return not crossing and plain == f"{MARK}{MARK}a{MARK}{MARK}b{MARK}" and sp.decode(sp.encode(probe)) == probe


class Encoder:
    """table: chunk (with its mark) -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, model: bytes, table: dict[str, bytes]):
        from sentencepiece import SentencePieceProcessor

        self.sp = SentencePieceProcessor(model_proto=model)
        self.split = chunks_are_independent(self.sp)
        self.table = table
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.sp.bos_id(), self.sp.eos_id()))
        self.mark = np.array([self.sp.piece_to_id(MARK)], "<u4").tobytes()

    def segmented(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk from the library, which puts the first mark itself."""
        found = self.sp.encode([x[1:] for x in chunks], num_threads=1)
        return [np.array(ids, "<u4").tobytes() if len(x) > 1 else self.mark for x, ids in zip(chunks, found, strict=True)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, begin and end included."""
        if not self.split:
            return [self.begin + np.array(self.sp.encode(t), "<u4").tobytes() + self.end for t in texts]
        chunks = [self._chunks(t) if t else [] for t in texts]
        rest = sorted(set().union(*chunks) - self.table.keys())
        own = dict(zip(rest, self.segmented(rest), strict=True))
        find = self.table.get
        return [self.begin + b"".join([find(x) or own[x] for x in c]) + self.end for c in chunks]

    @staticmethod
    def _chunks(text: str) -> list[str]:
        marked = MARK + text.replace(" ", MARK)
        return CHUNK.findall(marked) if MARK * 2 in marked or marked.endswith(MARK) else [MARK + x for x in marked[1:].split(MARK)]


def chunk_table(texts: DataFrame, model, most: int = TABLE) -> DataFrame:
    """chunk, ids: the most frequent marked words of the only column, each segmented once. model: a broadcast model file."""
    words = texts.select(F.explode(F.split(texts.columns[0], " ", -1)).alias("word")).where(f"length(word) between 1 and {LONGEST} and not contains(word, '{MARK}')")
    often = kept(words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1"), "pieces-words")
    # Counts fall into at most a few hundred classes; the least class from which on the words are few enough bounds the table.
    level = F.floor(8 * F.log2("n")).cast("int")
    sizes = sorted(often.groupBy(level.alias("level")).count().collect(), reverse=True)
    total, least = 0, None
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        least = r["level"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(model.value, {})
        for b in batches:
            chunks = [MARK + x for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(chunks), pa.array(enc.segmented(chunks) if enc.split else [b""] * len(chunks), pa.binary())], names=["chunk", "ids"])

    chosen = often.where(F.lit(False) if least is None else level >= least)
    return chosen.select("word").mapInArrow(run, "chunk string, ids binary")


#: The worker's own encoder, kept over batches and tasks of one call of :func:`encode`.
_own: dict[str, Encoder] = {}


def encode(docs: DataFrame, model_path: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """``docs`` without the text, with n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    The model file is read here and sent to the workers: its size is fixed. decoded_sha256
    is of the library's decode(ids).
    """
    context = docs.sparkSession.sparkContext
    with open(model_path, "rb") as f:
        data = f.read()
    model = context.broadcast(data)
    table = chunk_table(docs.select(text), model).toArrow()
    with pa.BufferOutputStream() as sink:
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        sent = context.broadcast(sink.getvalue().to_pybytes())
    key = hashlib.sha256(data + sent.value).hexdigest()

    def encoder() -> Encoder:
        if key not in _own:
            _own.clear()
            held = pa.ipc.open_stream(sent.value).read_all()
            _own[key] = Encoder(model.value, dict(zip(held.column("chunk").to_pylist(), held.column("ids").to_pylist(), strict=True)))
        return _own[key]

    results = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids
    rest = others(docs, text, *results)
    types = [T.LongType(), T.StringType(), T.StringType(), T.ArrayType(T.IntegerType())]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(c, t) for c, t in zip(results, types, strict=False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for b in batches:
            for at, part in in_steps(b.column(len(rest))):
                first = [i for i in range(len(part)) if not i or part[i] != part[i - 1]]
                times = np.diff([*first, len(part)])
                ids = enc([part[i] for i in first])
                said = [hashlib.sha256(enc.sp.decode(np.frombuffer(x, "<u4").tolist()).encode()).hexdigest() for x in ids]
                own = [[len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], said]
                made = [pa.array([x for x, n in zip(col, times, strict=True) for _ in range(n)]) for col in own]
                if keep_ids:
                    each = [x for x, n in zip(ids, times, strict=True) for _ in range(n)]
                    places = np.cumsum([0, *(len(x) // 4 for x in each)]).astype(np.int32)
                    made.append(pa.ListArray.from_arrays(pa.array(places), pa.array(np.frombuffer(b"".join(each), "<i4"))))
                yield pa.RecordBatch.from_arrays([b.column(i).slice(at, len(part)) for i in range(len(rest))] + made, names=[*rest, *results])

    return docs.select(*rest, text).mapInArrow(run, schema)
