"""Best-fit packing of tokenised documents by minimum bin slack.

Documents become token ids in Arrow tasks and are cut only where they exceed a sequence. Pieces are dealt by hash into
groups of a bounded number; a group fills one sequence after another: the longest piece left, and with it the subset of
the lengths left that comes nearest to the end, found by subset sums on the bits of one integer. Sequences that a group
could not fill are opened again and packed together with those of other groups.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlens.llm.common import travels_by_value
from reportlens.session import cut_lineage

travels_by_value(__name__)
LENGTH, GROUP, ROUNDS, CACHED = 2048, 4096, 3, 500_000


# A word of Latin letters and the marks behind it: lower-casing and composition change these letters one by one.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017f]*)([!-&(-/:-@\\[-`{-~]*)")


class _Ids(dict):
    """Token ids (little-endian 32-bit) of stretches between blanks. No token
    spans a blank, so that a text has the ids of its stretches in a row. Plain
    words go to the tokenizer's model directly, once for all spellings; its
    letters are the byte alphabet that the pre-tokenizer also makes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.words = tokenizer, tokenizer.model, {"": b""}
        self.packed = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        step = tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {c: "".join(w for w, _ in step(c)) for c in map(chr, range(0xC0, 0x180)) if c.isalpha()}
        super().__init__({"": b""})

    def text(self, text: str) -> bytes:
        text = text.lower() if text.isascii() else text
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def first(self, word: str) -> bytes:
        mapped = word if word.isascii() else "".join([self.letters.get(c, c) for c in word])
        packed = self.packed
        ids = b"".join([packed[t.id] for t in self.model.tokenize(mapped)])
        if len(self.words) > CACHED:
            self.words.clear()
            self.clear()
        self.words[word] = ids
        return ids

    def __missing__(self, stretch):
        plain = _PLAIN.fullmatch(stretch) if len(stretch) <= 64 else None
        if not plain:
            return b"".join([self.packed[i] for i in self.tokenizer.encode(stretch, add_special_tokens=False).ids])
        letters, marks = plain.groups()
        known = self.words.get(letters.lower())
        end = self.words.get(marks)
        if end is None:
            end = self.first(marks)
        if known is None:  # a word seen for the first time, as most are, is kept once only
            return self.first(letters.lower()) + end
        self[stretch] = ids = known + end
        return ids


def _tokenise(vocabulary: str, length: int, end_id: int, with_ids: bool):
    end, width = end_id.to_bytes(4, "little"), 4 * length

    def run(batches):
        from tokenizers import Tokenizer

        ids = _Ids(Tokenizer.from_file(vocabulary))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    all_ids = ids.text(text or "") + end
                    for k, i in enumerate(range(0, len(all_ids), width)):
                        piece = all_ids[i:i + width]
                        rows.append((doc, k, i // 4, len(piece) // 4, zlib.crc32(piece), piece))
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)])
    return run


def token_pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids: doc_id, piece, start, length, ids_crc32
    and, if asked for, ids. A document is its text's ids and ``end_id``; a null
    text has the end alone. ``vocabulary`` is a file every executor has."""
    made = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(_tokenise(vocabulary, length, end_id, with_ids), made)


def fullest(left: dict[int, int], room: int) -> list[int]:
    """Lengths out of ``left`` (length -> how many) whose sum comes nearest to
    ``room`` from below. Bit n of ``reach`` says that n is the sum of some."""
    reach, full, steps = 1, (1 << (room + 1)) - 1, []
    for n in sorted((n for n in left if n <= room), reverse=True):
        for _ in range(min(left[n], room // n)):
            more = (reach | reach << n) & full
            if more == reach:
                break
            steps.append((n, reach))
            reach = more
        if reach >> room:
            break
    best, taken = reach.bit_length() - 1, []
    for n, before in reversed(steps):
        if not before >> best & 1:
            taken.append(n)
            best -= n
    return taken


def minimum_slack(lengths: list[int], length: int) -> list[list[int]]:
    """Bins of places in ``lengths``, each filled before the next is begun."""
    places: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        places.setdefault(n, []).append(i)
    left, bins = {n: len(p) for n, p in places.items()}, []

    def take(n):
        left[n] -= 1
        if not left[n]:
            del left[n]
        return places[n].pop()
    while left:
        longest = max(left)
        taken = [take(longest)]
        taken += [take(n) for n in fullest(left, length - longest)]
        bins.append(taken)
    return bins


def _pack(length: int, turn: int):
    def run(key, frame):
        frame = frame.sort_values(["doc_id", "piece", "start", "length", "ids_crc32"], ignore_index=True)
        sizes = frame["length"].tolist()
        sequence, offset = [0] * len(sizes), [0] * len(sizes)
        filled = [0] * len(sizes)
        for k, places in enumerate(minimum_slack(sizes, length)):
            at = 0
            for i in places:
                sequence[i], offset[i] = (turn << 56) + (int(key[0]) << 20) + k, at
                at += sizes[i]
            for i in places:
                filled[i] = at
        return frame.assign(sequence_id=sequence, offset=offset, filled=filled)
    return run


def pack_pieces(pieces: DataFrame, length: int = LENGTH, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32, any others) with
    sequence_id and offset. Offsets of a sequence are gapless from 0; an empty
    table gives an empty result; repeated rows are pieces like others."""
    columns = pieces.columns
    made = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long, filled long"
    done, left = [], pieces
    for turn in range(rounds):
        n = left.count()
        if not n:
            break
        groups = -(-n // group)
        dealt = left.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn)), F.lit(groups)))
        packed = cut_lineage(dealt.groupBy("_group").applyInPandas(
            _without_group(_pack(length, turn)), made))
        last = turn == rounds - 1 or groups == 1
        done.append(packed if last else packed.where(F.col("filled") == length))
        if last:
            break
        left = packed.where(F.col("filled") < length).select(*columns)
    if not done:
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("filled")


def _without_group(run):
    def alone(key, frame):
        return run(key, frame.drop(columns="_group"))
    return alone


def pack_documents(docs: DataFrame, vocabulary: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack the rows of ``docs`` (doc_id, text, any others)."""
    return pack_pieces(cut_lineage(token_pieces(docs, vocabulary, length, with_ids=with_ids)), length)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the sequences themselves, of pieces with ids. A
    sequence is short, so that its pieces may meet in one task."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.aggregate("parts.ids", F.lit(b""), lambda a, x: F.concat(a, x))
    return parts.select("sequence_id", ids.alias("ids"))
