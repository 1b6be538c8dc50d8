"""SentencePiece encoding and decoding (12): BPE by vectorised merge rounds over Arrow batches.

A task cuts its texts into words, encodes the distinct words of a block and looks the rest up. All
distinct words lie in one flat array of symbols. A round takes the smallest pair rank of every
word (a segmented minimum), merges all its occurrences at once, the leftmost first where they
overlap, renews the ranks beside the merged symbols and compacts the array; words without a pair
leave. The result is that of merging the best pair of the text, leftmost first, one at a time:

* Merges never cross a place where no piece of the vocabulary has the two characters side by
  side, so words end there. Before a space after another character that holds in the usual
  vocabularies, and there texts are cut before anything else.
* Merging into a piece can make a pair that ranks before it (or with it) only where the vocabulary
  has such a pair; occurrences of these few pieces are merged one a round.

Characters without a piece become the pieces of their bytes. The vocabulary is read by the driver
from a path and reaches tasks as tables whose size is the vocabulary's; only models of the kind
``piece_bpe_32k.model`` is (BPE, byte fallback, no normalisation, a space put before each text)
are taken, others raise an error.

Defined results: a NULL text is the empty text, which has no pieces but the begin and end ids;
repeated texts are encoded alike; a text of any length is encoded whole, in as many rounds as its
longest unbreakable stretch needs; empty tables give no rows; a column of the input with the name
of an output is replaced, all others are carried as they are. Decoding takes any ids: bytes that are
no UTF-8 become one U+FFFD each, NULL decodes to the empty text, ids outside the vocabulary raise.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from archiveloom.llm import packing as pk
from archiveloom.llm import words as wd

SPACE = "▁"  # how pieces write a space
UNKNOWN = " ⁇ "  # how an unknown id is shown
NONE = np.int32(2**31 - 1)  # rank of two symbols that do not merge
BATCH_ROWS = 2_000
MODES = ("BPE with byte fallback", "no normalisation, spaces kept, one put first")


@dataclass
class Vocabulary:
    """A model as tables. Symbols are piece ids, and after them characters that are no piece."""

    n_pieces: int
    bos: int
    eos: int
    symbol_of: np.ndarray  # code point -> symbol, the last symbol for characters in no piece
    pairs: np.ndarray  # left * stride + right, sorted
    rank: np.ndarray  # of each pair, smaller merges first
    merged: np.ndarray  # the symbol each pair makes
    alone: np.ndarray  # per symbol: merge one occurrence a round
    touching: np.ndarray  # character symbols side by side in a piece: left * stride + right, sorted
    spaces_end_words: bool
    byte_ids: np.ndarray  # 256 ids
    shown: np.ndarray  # bytes of all pieces as decoded, one after another
    shown_at: np.ndarray  # where each begins
    is_space_first: np.ndarray  # per piece: begins with a space
    is_shown: np.ndarray  # per piece: not a control piece

    @property
    def stride(self) -> int:
        return len(self.alone)


def vocabulary(path: str) -> Vocabulary:
    """The tables of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    ids = range(n)
    piece = [model.id_to_piece(i) for i in ids]
    byte_of = {i: int(piece[i][1:-1], 16) for i in ids if model.is_byte(i)}
    special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)} | set(byte_of)
    if len(byte_of) != 256:
        raise ValueError(f"{path}: a model with {MODES[0]} is needed")
    probe = "ﬁ  A b "
    if model.decode(model.encode(probe)) != probe or model.encode("a a")[0] != model.encode("a")[0]:
        raise ValueError(f"{path}: a model with {MODES[1]} is needed")
    symbol = {piece[i]: i for i in ids if i not in special}
    chars = sorted({c for p in symbol for c in p} - set(symbol))
    symbol |= {c: n + i for i, c in enumerate(chars)}
    stride = n + len(chars) + 1  # the last symbol stands for all other characters
    scores = {i: model.get_score(i) for i in ids if i not in special}
    order = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
    found, touching, alone = [], set(), np.zeros(stride, bool)
    for text, i in symbol.items():
        if i >= n or len(text) == 1:
            continue
        touching |= {symbol[a] * stride + symbol[b] for a, b in zip(text, text[1:])}
        for cut in range(1, len(text)):
            left, right = symbol.get(text[:cut]), symbol.get(text[cut:])
            if left is not None and right is not None:
                found.append((left * stride + right, order[scores[i]], i))
                for part, size in ((left, cut), (right, len(text) - cut)):
                    # a piece made later than the pair it then belongs to
                    alone[part] |= size > 1 and order[scores[part]] >= order[scores[i]]
    found.sort()
    table = np.array(found, np.int64).reshape(-1, 3)
    symbol_of = np.full(0x110000, stride - 1, np.int32)
    for text, i in symbol.items():
        if len(text) == 1:
            symbol_of[ord(text)] = i
    shown = [UNKNOWN if model.is_unknown(i) else "" if i in special else piece[i].replace(SPACE, " ") for i in ids]
    raw = [bytes([byte_of[i]]) if i in byte_of else t.encode() for i, t in zip(ids, shown)]
    by_byte = {b: i for i, b in byte_of.items()}
    space = symbol_of[ord(SPACE)]
    crossing = [p for p in touching if p % stride == space and p // stride != space]
    return Vocabulary(
        n, model.bos_id(), model.eos_id(), symbol_of, table[:, 0], table[:, 1].astype(np.int32), table[:, 2].astype(np.int32),
        alone, np.array(sorted(touching), np.int64), not crossing, np.array([by_byte[b] for b in range(256)], np.int32),
        np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]),
        np.array([i not in special and piece[i].startswith(SPACE) for i in ids]),
        np.array([not model.is_control(i) for i in ids]),
    )


def _find(keys: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in the sorted ones, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def merge_rounds(v: Vocabulary, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of words after all merges, and the place of each one's first symbol in the input.

    ``first`` says where each word begins, none of them empty, and ends with the number of symbols.
    """
    word = np.repeat(np.arange(len(first) - 1), np.diff(first))  # whose symbol it is
    symbols, place = symbols.copy(), np.arange(len(symbols))
    done: list[tuple[np.ndarray, np.ndarray]] = []

    def rank_of(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of the pairs that begin at ``i``."""
        j = np.minimum(i + 1, len(symbols) - 1)
        at, known = _find(symbols[i].astype(np.int64) * v.stride + symbols[j], v.pairs)
        known &= (j > i) & (word[i] == word[j])
        return np.where(known, v.rank[at], NONE), v.merged[at]

    rank, made = rank_of(np.arange(len(symbols)))
    while len(symbols):
        starts = pk.runs((word, 0))
        best = np.repeat(np.minimum.reduceat(rank, starts), pk.run_lengths(starts, len(word)))
        ended = best == NONE
        if ended.any():
            done.append((symbols[ended], place[ended]))
            symbols, place, word, rank, made, best = (x[~ended] for x in (symbols, place, word, rank, made, best))
            if not len(symbols):
                break
        at = np.flatnonzero(rank == best)
        owner = word[at]
        # of occurrences that overlap, the first, the third, ...
        chain = pk.runs((at, 1), (owner, 0))
        turn = np.arange(len(at)) - np.repeat(chain, pk.run_lengths(chain, len(at)))
        leftmost = np.zeros(len(at), bool)
        leftmost[pk.runs((owner, 0))] = True
        # a word with a piece that goes alone among them has one merge this round
        held = np.zeros(int(word[-1]) + 1, bool)
        held[owner[v.alone[made[at]]]] = True
        at = at[np.where(held[owner], leftmost, turn % 2 == 0)]
        symbols[at] = made[at]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, place, word, rank, made = (x[keep] for x in (symbols, place, word, rank, made))
        changed = at - np.arange(len(at))  # each merge before it took one symbol away
        changed = np.concatenate((changed, np.maximum(changed - 1, 0)))
        rank[changed], made[changed] = rank_of(changed)
    if not done:
        return symbols, place
    symbols, place = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(place)
    return symbols[order], place[order]


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and where each begins."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(lead, len(data)))
    points = data[lead].astype(np.int32)
    points &= np.array([0, 0x7F, 0x1F, 0x0F, 0x07], np.int32)[size]
    for i in range(1, 4):
        longer = np.flatnonzero(size > i)
        points[longer] = points[longer] << 6 | (data[lead[longer] + i] & 0x3F)
    return points, lead


def encode_words(v: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words given as slices of UTF-8 ``data``, flat, and where each word's ids begin."""
    points, lead = _code_points(data)
    points[points == 0x20] = ord(SPACE)
    chars = v.symbol_of[points]
    begins = np.zeros(len(chars) + 1, bool)
    word_first = np.searchsorted(lead, offsets)
    begins[word_first] = True
    if len(chars) > 1:
        begins[1:-1] |= ~_find(chars[:-1].astype(np.int64) * v.stride + chars[1:], v.touching)[1]
    symbols, place = merge_rounds(v, chars, np.flatnonzero(begins))
    # what is no piece is a single character, and becomes the pieces of its bytes
    odd = np.flatnonzero(symbols >= v.n_pieces)
    sizes = np.ones(len(symbols), np.int64)
    sizes[odd] = np.diff(np.append(lead, len(data)))[place[odd]]
    ids = np.repeat(symbols, sizes)
    at = np.cumsum(sizes) - sizes
    ids[pk.expand(at[odd], sizes[odd])] = v.byte_ids[data[pk.expand(lead[place[odd]], sizes[odd])]]
    return ids, np.append(at, len(ids))[np.searchsorted(place, word_first)]


def encode(v: Vocabulary, column: pa.Array, bos: bool, eos: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, flat, and where each text's ids begin; one more at the end."""
    column = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), SPACE, " ")
    column = pc.if_else(pc.equal(column, ""), column, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string())))
    data, offsets = wd.utf8(column)
    ids, upto, n_words = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    which = np.zeros(0, np.int64)
    if len(data):
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        if v.spaces_end_words:
            begins[1:-1] |= (data[1:] == 0x20) & (data[:-1] != 0x20)
        cuts = np.flatnonzero(begins)
        words = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
        distinct = words.dictionary.cast(pa.large_binary())
        at = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1]
        ids, upto = encode_words(v, np.frombuffer(distinct.buffers()[2], np.uint8)[: at[-1]], at)
        which = words.indices.to_numpy().astype(np.int64)
        n_words = np.diff(np.searchsorted(cuts[:-1], offsets))
    sizes = np.diff(upto)[which]
    word_at = np.append(0, np.cumsum(sizes))
    text_at = word_at[np.append(0, np.cumsum(n_words))] + np.arange(len(n_words) + 1) * (bos + eos)
    out = np.full(int(text_at[-1]), v.eos, np.int32)
    if bos:
        out[text_at[:-1]] = v.bos
    shift = np.repeat(np.arange(len(n_words)), n_words) * (bos + eos) + bos
    out[pk.expand(word_at[:-1] + shift, sizes)] = ids[pk.expand(upto[:-1][which], sizes)]
    return out, text_at


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "\ufffd" * (error.end - error.start), error.end


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Slices of bytes as texts; each byte that is no UTF-8 becomes one U+FFFD."""
    raw = pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    )
    try:
        return raw.cast(pa.large_string())
    except pa.ArrowInvalid:
        codecs.register_error("each-byte", _each_byte)
        return pa.array([b.decode("utf-8", "each-byte") for b in raw.to_pylist()], pa.large_string())


def decode(v: Vocabulary, ids: np.ndarray, first: np.ndarray) -> pa.Array:
    """Texts of flat ids; ``first`` says where each text's ids begin, and ends with their number."""
    if len(ids) and (ids.min() < 0 or ids.max() >= v.n_pieces):
        raise ValueError("an id is outside the vocabulary")
    starts, sizes = v.shown_at[:-1][ids], np.diff(v.shown_at)[ids]
    # the space that was put before the text is the first thing shown, if at all
    seen = np.append(0, np.cumsum(v.is_shown[ids]))
    lead = np.searchsorted(seen, seen[first[:-1]] + 1) - 1
    lead = lead[(lead >= first[:-1]) & (lead < first[1:])]
    lead = lead[v.is_space_first[ids[lead]]]
    starts[lead] += 1
    sizes[lead] -= 1
    data = v.shown[pk.expand(starts, sizes)]
    offsets = np.append(0, np.cumsum(sizes))
    # bytes on both sides of a control piece do not belong together
    hidden = np.flatnonzero(~v.is_shown[ids])
    is_byte = np.zeros(v.n_pieces, bool)
    is_byte[v.byte_ids] = True
    near = is_byte[ids[np.maximum(hidden - 1, 0)]] & is_byte[ids[np.minimum(hidden + 1, len(ids) - 1)]]
    near |= (np.diff(hidden, prepend=-2) == 1) | (np.diff(hidden, append=len(ids) + 2) == 1)
    cuts = np.unique(np.append(first, hidden[near]))
    parts = _texts(data, offsets[cuts])
    if len(cuts) == len(first) and np.array_equal(cuts, first):
        return parts
    parts = parts.to_pylist()
    upto = np.searchsorted(cuts, first)
    return pa.array(["".join(parts[lo:hi]) for lo, hi in zip(upto[:-1], upto[1:])], pa.large_string())


def _encoder(model, text: str, packed: bool, bos: bool, eos: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = model.value
        for table in pk.blocks(batches, text):
            column = table[text].combine_chunks()
            ids, first = encode(v, column, bos, eos)
            if packed:
                out = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(first * 4), pa.py_buffer(ids.astype("<u4"))])
            else:
                out = pa.LargeListArray.from_arrays(pa.array(first), pa.array(ids))
            own = {"n_tokens": pa.array(np.diff(first)), "ids": out}
            yield from _batches(table, own, schema)

    return run


def _batches(table: pa.Table, own: dict[str, pa.Array], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of ``schema`` from new columns and those of the input, few texts at a time."""
    columns = [own[c] if c in own else table[c] for c in schema.names]
    for at in range(0, table.num_rows, BATCH_ROWS):
        part = [c.slice(at, BATCH_ROWS).cast(f.type) for c, f in zip(columns, schema)]
        yield from pa.table(part, schema=schema).to_batches()


def _decoder(model, ids: str, out: str, packed: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = model.value
        for batch in batches:
            column = batch.column(ids)
            if packed:
                column = column.cast(pa.large_binary()).fill_null(b"")
                at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
                flat = np.frombuffer(column.buffers()[2] or b"", "<u4")[at[0] // 4 : at[-1] // 4]
                first = (at - at[0]) // 4
            else:
                sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                first = np.append(0, np.cumsum(sizes))
                flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
            text = decode(v, flat.astype(np.int64), first)
            yield from _batches(pa.Table.from_batches([batch]), {out: text}, schema)

    return run


def _mapped(df: DataFrame, keep: list[str], new: list[T.StructField], task) -> DataFrame:
    schema = T.StructType([*df.select(*keep).schema.fields, *new])
    return df.mapInArrow(task(to_arrow_schema(schema)), schema)


def encoded(
    docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text", packed: bool = False, bos: bool = True, eos: bool = True
) -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` with ``n_tokens`` and ``ids``.

    ``ids`` are an array of numbers, or with ``packed`` little-endian 32-bit numbers in one binary
    value, as token files have them. ``path`` is read by the driver.
    """
    pk.small_batches(docs.sparkSession)
    keep = [c for c in (keep or docs.columns) if c not in ("n_tokens", "ids")]
    model = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType() if packed else T.ArrayType(T.IntegerType()))]
    rows = docs.select(*dict.fromkeys([*keep, text]))
    return _mapped(rows, keep, new, lambda schema: _encoder(model, text, packed, bos, eos, schema))


def decoded(df: DataFrame, path: str, keep: list[str] | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Columns ``keep`` (default: all) of ``df`` with ``out``, the text of ``ids`` in either form."""
    pk.small_batches(df.sparkSession)
    keep = [c for c in (keep or df.columns) if c != out]
    packed = isinstance(df.schema[ids].dataType, T.BinaryType)
    model = df.sparkSession.sparkContext.broadcast(vocabulary(path))
    rows = df.select(*dict.fromkeys([*keep, ids]))
    return _mapped(rows, keep, [T.StructField(out, T.StringType())], lambda schema: _decoder(model, ids, out, packed, schema))
