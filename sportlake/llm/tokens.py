"""Two tokenizers' tokens of the same texts, aligned by their bytes.

Both tokenizations tile the bytes of a text. Each token start finds, by an ordered merge of the token
tables of a batch (``pandas.merge_asof``), the token of the other side that covers it; the union
of both directions are the pairs that overlap. Bytes where tokens of both sides end cut the
text into groups, and every pair of a group is a link.

Where both tokenizers are known to cut, at one space between characters that are not white space, a text
falls into pieces that are tokenized and aligned by themselves with the same result. Equal pieces of a
batch are worked out once, so the merge is keyed by piece; a text that cannot be cut is one piece.

An id pair's count is the number of texts that link it. Pairs are counted with map-side
sums. The pairs of most texts, as many as a broadcast of fixed size holds, are looked up
where the texts are and never shuffled, so no common pair meets all texts in one task; all others
are looked up by a shuffled join. The result does not depend on which pairs these are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportlake.llm.tables import stored

FOLDER = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of texts that are taken together; a longer text is taken alone.
SLICE = 1 << 21
#: Pieces that are tokenized as one string.
JOINED = 512
#: Pairs that are broadcast at most, 16 bytes each.
BROADCAST = 1 << 18
#: White space, of which one blank between other characters is a cut.
_WHITE = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_UNEVEN = f"(^|[{_WHITE}]) | ([{_WHITE}]|$)"
_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Pieces that are not plain: other than letters, digits and signs whose kind is the same in all versions
#: of Unicode, or white space at an end, as only the first and the last piece of a text may have it.
_OTHER = f"[^\\x{{20}}-\\x{{7e}}\\n\\x{{c0}}-\\x{{24f}}]|^[{_WHITE}]|[{_WHITE}]$"
#: Fixed value: how byte-level tokenizers part a text.
_PARTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level_alphabet() -> dict[str, int]:
    """Character of each byte in byte-level entries: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """A byte-level tokenizer (JSON); texts are taken with a space before them."""

    def __init__(self, path: str) -> None:
        import tokenizers

        self.model = tokenizers.Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        alphabet = byte_level_alphabet()
        special = {t.content for t in self.model.get_added_tokens_decoder().values()}
        vocabulary = self.model.get_vocab()
        self.entries = {
            i: entry.encode() if entry in special else bytes(alphabet[c] for c in entry)
            for entry, i in vocabulary.items()
        }
        declared = json.loads(self.model.to_str())
        before = declared["pre_tokenizer"] or {}
        #: No token crosses one space between other characters.
        self.cuts = (
            declared["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", False)
            and not before.get("add_prefix_space", True)
        )
        self.ranked = None
        merges = [m.split(" ") if isinstance(m, str) else m for m in declared["model"]["merges"]]
        if self.cuts and all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)):
            # Ids are the order of merges, so the same vocabulary runs as ranks, which is faster.
            import tiktoken

            ranks = {entry: i for i, entry in self.entries.items() if i < 256 + len(merges)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.model.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)
        return [own.ids for own in found]

    def encode_all(self, texts: list[str], plain: bool) -> np.ndarray:
        """Ids of all texts in a row; ``plain`` says that they hold plain characters only."""
        if plain and self.ranked is not None:
            return self.ranked.encode_to_numpy(" " + " ".join(texts)).astype(np.int64)
        return _flat(self.encode(texts))


class Pieces:
    """A tokenizer of pieces with byte fallback, which puts a space before texts itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.entries = {
            i: bytes([int(name[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", name) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        }
        apart = self.model.encode("a  b", out_type=str)
        #: No entry has a space within, and spaces are kept as they are.
        self.cuts = not any(re.search("[^▁]▁", name) for name in names) and "".join(apart) == "▁a▁▁b"

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def encode_all(self, texts: list[str], plain: bool) -> np.ndarray:
        """Ids of all texts in a row; ``plain`` as above."""
        if plain and self.cuts:
            texts = [" ".join(texts[low : low + JOINED]) for low in range(0, len(texts), JOINED)]
        return _flat(self.encode(texts))


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.concatenate([np.array(own, np.int64) for own in ids]) if ids else np.zeros(0, np.int64)


class Entries:
    """Bytes of each id of a vocabulary, to be written out for many ids at once."""

    def __init__(self, entries: dict[int, bytes]) -> None:
        self.bytes = pa.array([entries.get(i, b"") for i in range(max(entries) + 1)], pa.binary())
        self.sizes = np.array([len(entries.get(i, b"")) for i in range(max(entries) + 1)])
        self.names = pa.array([str(i) for i in range(max(entries) + 1)], pa.string())

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return _content(self.bytes.take(pa.array(ids)))


def _content(strings: pa.Array) -> np.ndarray:
    """All bytes of an array of strings or binaries."""
    _, at, data = strings.buffers()
    ends = np.frombuffer(at, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]]


@dataclass
class Aligned:
    """Alignment of some pieces, all values in the order of the pieces."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_overlaps: np.ndarray
    #: Linked pairs by their place in ``ids``, how often, and where each piece's begin.
    pairs: np.ndarray
    links: np.ndarray
    begins: np.ndarray
    #: Different linked ids, ``a << 32 | b``, ascending.
    ids: np.ndarray
    groups: pa.Array


def token_table(ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    """A row for each token: its ``piece``, ``id``, and bytes from ``start`` to ``end``.

    Bytes are numbered through all pieces, which end at ``ends``, so starts ascend.
    """
    end = np.cumsum(sizes[ids])
    start = end - sizes[ids]
    return pd.DataFrame({"piece": np.searchsorted(ends, start, "right"), "id": ids, "start": start, "end": end})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Pairs of rows of two token tables that share a byte, ``at_a, at_b``.

    Each start finds the other side's covering token; a pair overlaps if the start of the one lies in the other.
    """
    a = a[["piece", "start"]].assign(at_a=np.arange(len(a)))
    b = b[["piece", "start"]].assign(at_b=np.arange(len(b)))
    covering = pd.merge_asof(a, b, on="start", by="piece")
    covered = pd.merge_asof(b, a, on="start", by="piece")
    # Both directions give pairs that start at one byte.
    covered = covered[covered["start"].to_numpy() > a["start"].to_numpy()[covered["at_a"]]]
    return pd.concat([covering[["at_a", "at_b"]], covered[["at_a", "at_b"]]], ignore_index=True)


def align(a: pd.DataFrame, b: pd.DataFrame, n: int, names_a: pa.Array, names_b: pa.Array) -> Aligned:
    """Alignment of ``n`` pieces from the token tables of both sides and the names of their ids."""
    both = overlaps(a, b)
    shared = np.intersect1d(a["end"], b["end"], assume_unique=True)
    group_a, group_b = np.searchsorted(shared, a["end"]), np.searchsorted(shared, b["end"])
    group_piece = np.zeros(len(shared), np.int64)
    group_piece[group_a] = a["piece"]
    n_groups = np.bincount(group_piece, minlength=n)
    # Within a group each different id once, with how often it occurs: their products are the links.
    ids_of_a, times_a, _, count_a = _distinct(group_a, a["id"].to_numpy(), len(shared))
    ids_of_b, times_b, first_b, count_b = _distinct(group_b, b["id"].to_numpy(), len(shared))
    # A row of each group's ids of a is paired with all its ids of b.
    group_of = np.repeat(np.arange(len(shared)), count_a)
    wide = count_b[group_of]
    row = np.repeat(np.arange(len(ids_of_a)), wide)
    other = first_b[group_of[row]] + np.arange(len(row)) - np.repeat(np.cumsum(wide) - wide, wide)
    codes, ids = pd.factorize(ids_of_a[row] << 32 | ids_of_b[other], sort=True)
    piece, pairs, links = _summed(group_piece[group_of[row]], codes.astype(np.int64), times_a[row] * times_b[other])
    written = [
        pc.binary_join(_lists(names.take(pa.array(table["id"].to_numpy())), np.bincount(group, minlength=len(shared))), ",")
        for names, table, group in ((names_a, a, group_a), (names_b, b, group_b))
    ]
    return Aligned(
        np.bincount(a["piece"], minlength=n),
        np.bincount(b["piece"], minlength=n),
        n_groups,
        np.bincount(a["piece"].to_numpy()[both["at_a"]], minlength=n),
        pairs,
        links,
        np.concatenate([[0], np.cumsum(np.bincount(piece, minlength=n))]),
        ids,
        pc.binary_join(_lists(pc.binary_join_element_wise(*written, "|"), n_groups), ";"),
    )


def _distinct(group: np.ndarray, ids: np.ndarray, groups: int) -> tuple[np.ndarray, ...]:
    """Different ids by group, how often each occurs, and each group's first and number of them."""
    group, ids, times = _summed(group, ids, np.ones(len(ids), np.int64))
    count = np.bincount(group, minlength=groups)
    return ids, times, np.cumsum(count) - count, count


def _summed(owner: np.ndarray, keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys of each owner, ascending, with the sum of their times; keys are below 2^31."""
    both = owner << 31 | keys
    order = np.argsort(both)
    both = both[order]
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    starts = np.flatnonzero(new)
    times = np.add.reduceat(times[order], starts) if len(starts) else times
    both = both[starts]
    return both >> 31, both & 0x7FFFFFFF, times


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    cuts = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)


class Aligner:
    """Both tokenizers; one for each worker."""

    def __init__(self, a: ByteLevel, b: Pieces) -> None:
        self.a, self.b = a, b
        self.of_a, self.of_b = Entries(a.entries), Entries(b.entries)
        self.cuts = a.cuts and b.cuts

    def pieces(self, text: str) -> list[str]:
        """The pieces of one text."""
        return _SPACE.split(text) if self.cuts else [text]

    def all_pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of texts that are not empty, and how many each has."""
        if self.cuts and not pc.any(pc.match_substring_regex(texts, _UNEVEN)).as_py():
            lists = pc.split_pattern(texts, " ")
            return lists.flatten(), pc.list_value_length(lists).to_numpy()
        own = [self.pieces(text) for text in texts.to_pylist()]
        return pa.array([piece for part in own for piece in part], pa.string()), np.array([len(part) for part in own])

    def learn(self, pieces: pa.Array) -> tuple[Aligned, np.ndarray]:
        """Alignment of different pieces, and which of them both sides reproduce; others have no tokens."""
        other = pc.match_substring_regex(pieces, _OTHER).to_numpy(zero_copy_only=False)
        order = np.argsort(other, kind="stable")  # plain ones first
        texts = pieces.take(pa.array(order)).to_pylist()
        plain = len(texts) - int(other.sum())
        found = [self._tokens(part, i == 0) for i, part in enumerate((texts[:plain], texts[plain:]))]
        valid = np.zeros(len(texts), bool)
        valid[order] = np.concatenate([own for _, _, own in found])
        sizes = pc.binary_length(pieces.cast(pa.binary())).to_numpy(zero_copy_only=False) + 1
        sizes = np.where(valid, sizes, 0)[order]
        ends = np.cumsum(sizes)
        a, b = (
            token_table(np.concatenate([part[side] for part in found]), own.sizes, ends)
            for side, own in ((0, self.of_a), (1, self.of_b))
        )
        aligned = align(a, b, len(texts), self.of_a.names, self.of_b.names)
        return _reordered(aligned, np.argsort(order, kind="stable")), valid

    def _tokens(self, texts: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, those of pieces that are not reproduced left out, and which are."""
        valid = np.ones(len(texts), bool)
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), valid
        a, b = self.a.encode_all(texts, plain), self.b.encode_all(texts, plain)
        whole = np.frombuffer((" " + " ".join(texts)).encode(), np.uint8)
        if all(np.array_equal(own.joined(ids), whole) for own, ids in ((self.of_a, a), (self.of_b, b))):
            return a, b, valid
        ids_a, ids_b = self.a.encode(texts), self.b.encode(texts)
        for i, (text, own_a, own_b) in enumerate(zip(texts, ids_a, ids_b, strict=True)):
            want = (" " + text).encode()
            joined = [b"".join(map(side.entries.__getitem__, ids)) for side, ids in ((self.a, own_a), (self.b, own_b))]
            if joined != [want, want]:
                valid[i] = False
                ids_a[i], ids_b[i] = [], []
        return _flat(ids_a), _flat(ids_b), valid


def _reordered(aligned: Aligned, places: np.ndarray) -> Aligned:
    """The same alignments, piece ``i`` being that at ``places[i]``."""
    counts = np.diff(aligned.begins)[places]
    begins = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(aligned.begins[places] - begins[:-1], counts) + np.arange(begins[-1])
    numbers = [getattr(aligned, name)[places] for name in COLUMNS[:4]]
    groups = aligned.groups.take(pa.array(places))
    return Aligned(*numbers, aligned.pairs[at], aligned.links[at], begins, aligned.ids, groups)


@lru_cache(2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(ByteLevel(path_a), Pieces(path_b))


COLUMNS = ("n_a", "n_b", "n_groups", "n_overlaps", "n_links")


def align_texts(texts: pa.Array, aligner: Aligner) -> list[pa.Array]:
    """Columns for some texts: ``COLUMNS``, groups as text, distinct pairs and how often each is linked."""
    n = len(texts)
    held = np.flatnonzero(pc.fill_null(pc.greater(pc.utf8_length(texts), 0), False).to_numpy(zero_copy_only=False))
    pieces, counts = aligner.all_pieces(texts.take(pa.array(held)).cast(pa.string()))
    encoded = pieces.dictionary_encode()
    known, valid = aligner.learn(encoded.dictionary)
    numbers = encoded.indices.to_numpy().astype(np.int64)
    text = np.repeat(held, counts)
    if not valid.all():  # a text with a piece that is not reproduced has no tokens at all
        lost = np.isin(text, np.unique(text[~valid[numbers]]))
        numbers, text = numbers[~lost], text[~lost]
    total = [np.bincount(text, getattr(known, name)[numbers], n).astype(np.int64) for name in COLUMNS[:4]]
    groups = pc.binary_join(_lists(known.groups.take(pa.array(numbers)), np.bincount(text, minlength=n)), ";")
    # Each different piece of a text once, then the distinct pairs of these.
    text, piece, often = _summed(text, numbers, np.ones(len(numbers), np.int64))
    low, own = known.begins[piece], known.begins[piece + 1] - known.begins[piece]
    at = np.arange(int(own.sum())) + np.repeat(low - (np.cumsum(own) - own), own)
    text, pairs, links = _summed(np.repeat(text, own), known.pairs[at], known.links[at] * np.repeat(often, own))
    counts = np.bincount(text, minlength=n)
    total.append(np.bincount(text, links, n).astype(np.int64))
    lists = [_lists(pa.array(values, pa.int64()), counts) for values in (known.ids[pairs], links)]
    return [*[pa.array(values, pa.int64()) for values in total], groups, *lists]


def _slices(column: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of ``SLICE`` bytes together, or one text that is longer."""
    sizes = pc.fill_null(pc.binary_length(column.cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    low = 0
    while low < len(column):
        high = low + max(1, int(np.searchsorted(np.cumsum(sizes[low:]), SLICE, "right")))
        yield column.slice(low, high - low)
        low = high


def aligned(docs: DataFrame, path_a: str = f"{FOLDER}/{BYTE_LEVEL}", path_b: str = f"{FOLDER}/{PIECES}") -> DataFrame:
    """Alignment of the tokens of each row of ``docs`` (doc_id, text, more columns).

    Returns ``row`` (a number of its own for each row), ``doc_id, n_a, n_b, n_groups, n_overlaps, n_links, groups`` (ids as
    ``a1,a2|b1;a3|b2,b3``), ``pairs`` (distinct linked ids, ``a << 32 | b``, ascending) and ``links`` (how often
    each). The files of both tokenizers must lie at these paths on all executors.

    Null and empty texts, and texts whose tokens do not join to a space and the text, have no
    tokens: zeros and empty lists. Rows are worked out one by one, so null and repeated ids and
    repeated rows each give a row; an empty table gives none. A text of any length is tokenized whole.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(2)):
                keys = [batch.column(i).slice(at, len(texts)) for i in (0, 1)]
                names = ["row", "doc_id", *COLUMNS, "groups", "pairs", "links"]
                yield pa.RecordBatch.from_arrays([*keys, *align_texts(texts, aligner)], names=names)
                at += len(texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{name} bigint" for name in COLUMNS)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(
        found, f"row bigint, doc_id {kind}, {numbers}, groups string, pairs array<bigint>, links array<bigint>"
    )


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, texts, best``: how many rows link each pair, and whether no pair of the same first id has more."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("texts"))
    counts = stored(counts, "pairs")
    # One row for each id of the first vocabulary.
    highest = counts.groupBy(F.expr("pair >> 32").alias("a")).agg(F.max("texts").alias("most"))
    joined = counts.join(highest, F.expr("pair >> 32") == F.col("a"))
    return joined.select("pair", "texts", (F.col("texts") == F.col("most")).alias("best"))


def _threshold(counts: DataFrame, most: int) -> int:
    """Smallest bound on ``texts``, in steps of an eighth of a power of two, that at most ``most`` pairs reach."""
    step = F.floor(F.log2("texts") * 8).cast("int").alias("step")
    steps = counts.groupBy(step).agg(F.count("*").alias("n"), F.min("texts").alias("texts"))
    bound, total = 1 << 62, 0
    for row in steps.orderBy(F.desc("step")).collect():  # some 8 * 63 rows at most
        total += row["n"]
        if total > most:
            break
        bound = row["texts"]
    return bound


def scored(found: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """``row, n_best, count_sum`` for the rows of ``aligned`` that have links; read from a written table.

    ``count_sum`` adds up the pair's count over all links; ``n_best`` counts links whose pair is
    in as many rows as any pair of its first id, ties included.
    """
    counts = stored(pair_counts(found), "counts")
    bound = _threshold(counts, broadcast)
    each = found.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("e"))
    each = each.select("row", F.col("e.pairs").alias("pair"), F.col("e.links").alias("links"))
    common = F.broadcast(counts.where(F.col("texts") >= bound))  # as many as ``broadcast`` at most
    near = each.join(common, "pair").groupBy("row").agg(*_sums("links", "texts", "best"))
    rest = each.join(common, "pair", "left_anti").join(counts.where(F.col("texts") < bound), "pair")
    far = rest.groupBy("row").agg(*_sums("links", "texts", "best"))
    return near.unionByName(far).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _sums(links: str, texts: str, best: str):
    return (
        F.sum(F.when(F.col(best), F.col(links)).otherwise(0)).alias("n_best"),
        F.sum(F.col(links) * F.col(texts)).alias("count_sum"),
    )
