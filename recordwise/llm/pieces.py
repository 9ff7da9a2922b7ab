"""Sampled SentencePiece segmentation by forward filtering and backward sampling, and lossless decoding.

A text becomes ``▁`` for each space, with one ``▁`` in front. Its lattice has an edge for every
vocabulary piece that matches somewhere; a character that is no piece is one edge of byte pieces.
No piece has a ``▁`` behind another character, so the lattice falls apart before each ``▁`` that
follows one, and equal units of a batch share their lattice. Forward filtering sums, per unit and
position, the weight of all segmentations that end there; backward sampling then walks each
occurrence from its end and draws the last piece in proportion to (sum before it) x (its weight),
which samples whole segmentations by their probability, up to the 24 bits of a draw. Draws come from a hash
of the row key and the character position, so a row's result depends on nothing else: not on its partition,
batch or neighbours.

A BPE model has merge ranks instead of probabilities; a piece of rank r gets the Zipf weight
``1 / (r + 2.7)`` (normalised), to the power ``alpha``. Decoding joins the pieces' bytes, turns ``▁``
into spaces and drops the first; a literal ``▁`` in a text is encoded as bytes, so decoding always
returns the text.

Defined cases: a NULL text is an empty one and has no pieces; a NULL key seeds like the key 0;
rows that repeat key and text get equal pieces; very long texts are encoded whole; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.llm.spans import BASES, U64, Prefix, buffer_of, mixed, slices

MODEL = "piece_bpe_32k.model"
MARK = 0x2581
LITERAL = 0x10FFFF + 1  # stands for a literal ▁ while encoding; no piece has it
BYTES_EDGE = -2
LONG_UNIT = 2048  # characters; such a unit (text without spaces) has a pass of its own
LONG_BLOCK = 1 << 15


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary as a trie in one hash table, with weights and bytes per id."""

    def __init__(self, path: str, alpha: float):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_ids = np.zeros(256, np.int64)
        children: dict[tuple[int, int], int] = {}
        piece_of, names, ranks, self.longest = [-1], [b""] * n, np.full(n, np.nan), 1
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], names[i] = i, bytes([value])
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"a piece has a mark behind another character: {piece!r}")
            names[i], ranks[i] = piece.replace("▁", " ").encode(), -model.get_score(i)
            self.longest = max(self.longest, len(piece))
            node = 0
            for c in piece:
                step = (node, ord(c))
                if step not in children:
                    children[step] = len(piece_of)
                    piece_of.append(-1)
                node = children[step]
            piece_of[node] = i
        weight = 1.0 / (np.maximum(ranks, 0) + 2.7)
        total = np.nansum(weight)
        self.log_weight = np.where(np.isnan(ranks), -np.inf, alpha * np.log(weight / total))
        self.log_byte = alpha * np.log(1.0 / (n + 2.7) / total)
        self.piece_of = np.array(piece_of, np.int64)
        self.flat = np.frombuffer(b"".join(names), np.uint8)
        self.name_ends = np.cumsum([len(x) for x in names])
        self.name_sizes = np.array([len(x) for x in names], np.int64)
        self._hash(children)

    def _hash(self, children: dict[tuple[int, int], int]) -> None:
        size = 1 << max(10, (8 * len(children)).bit_length())
        self.mask = size - 1
        self.table_key, self.table_child = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        keys = np.array([(node << 21) | c for node, c in children], np.int64)
        child, at = np.array(list(children.values()), np.int64), self.slot(keys)
        self.probes = 0
        while len(keys):
            free = self.table_key[at] < 0
            _, first = np.unique(at, return_index=True)
            mine = np.zeros(len(keys), bool)
            mine[first] = True
            mine &= free
            self.table_key[at[mine]], self.table_child[at[mine]] = keys[mine], child[mine]
            keys, child, at = keys[~mine], child[~mine], (at[~mine] + 1) & self.mask
            self.probes += 1

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(U64) * U64(BASES[0])) >> U64(40)).astype(np.int64) & self.mask

    def children(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        keys = (nodes << 21) | chars
        at = self.slot(keys)
        found = np.where(self.table_key[at] == keys, self.table_child[at], -1)
        open_ = np.flatnonzero((found < 0) & (self.table_key[at] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            stored = self.table_key[at[open_]]
            same = stored == keys[open_]
            found[open_[same]] = self.table_child[at[open_[same]]]
            open_ = open_[~same & (stored >= 0)]
        return found


def utf8_sizes(chars: np.ndarray) -> np.ndarray:
    return 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000).astype(np.int64)


def lattice(p: Pieces, chars: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges and backward distributions of units that lie behind each other in ``chars``.

    Unit u has ``sizes[u] + 1`` slots, one per position, from ``bases[u]``. ``edges[slot, k]`` is the id of
    the piece of k + 1 characters that ends there (-1: none), ``draw[slot]`` the running sums of
    the probabilities that the last piece has 1, 2, ... characters.
    """
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    unit = np.repeat(np.arange(len(sizes)), sizes)
    bases = starts + np.arange(len(sizes))
    slot = np.arange(len(chars)) + unit  # of the position before each character
    left = (starts + sizes)[unit] - np.arange(len(chars))
    edges = np.full((len(chars) + len(sizes), p.longest), -1, np.int32)
    at, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
    for k in range(p.longest):
        if k:
            inside = left[at] > k
            at, node = at[inside], node[inside]
        node = p.children(node, chars[at + k])
        alive = node >= 0
        at, node = at[alive], node[alive]
        if not len(at):
            break
        piece = p.piece_of[node]
        ends = piece >= 0
        edges[slot[at[ends]] + k + 1, k] = piece[ends]
    bare = edges[slot + 1, 0] < 0
    edges[slot[bare] + 1, 0] = BYTES_EDGE
    spelled = np.where(chars == LITERAL, 3, utf8_sizes(chars)) * p.log_byte
    log_sum = np.zeros(len(edges))
    draw = np.ones((len(edges), p.longest), np.float32)
    weights = np.concatenate([p.log_weight, [0.0, -np.inf]])  # -2 gets its weight below, -1 has none
    for u in np.flatnonzero(sizes > LONG_UNIT).tolist():
        here = slice(int(bases[u]), int(bases[u] + sizes[u]) + 1)
        long_unit(edges[here], draw[here], weights, spelled[starts[u] : starts[u] + sizes[u]])
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] <= LONG_UNIT]
    ordered, first = sizes[order], bases[order]
    back = np.arange(1, p.longest + 1)
    char_at = starts[order]
    for i in range(1, int(ordered[0]) + 1 if len(ordered) else 0):
        alive = int(np.searchsorted(-ordered, -i, "right"))
        here = first[:alive] + i
        reach = min(i, p.longest)
        edge = edges[here, :reach]
        value = weights[edge]
        spelled_out = edge[:, 0] == BYTES_EDGE
        value[spelled_out, 0] = spelled[char_at[:alive][spelled_out] + i - 1]
        value += log_sum[here[:, None] - back[:reach]]
        top = value.max(1)
        sums = np.cumsum(np.exp(value - top[:, None]), 1)
        log_sum[here] = top + np.log(sums[:, -1])
        draw[here, :reach] = sums / sums[:, -1:]
    return bases, edges, draw


def long_unit(edges: np.ndarray, draw: np.ndarray, weights: np.ndarray, spelled: np.ndarray) -> None:
    """``draw`` of one long unit. Only the sum of each position waits for those before it, so only it is found one by one."""
    longest = edges.shape[1]
    places, steps = np.nonzero(edges != -1)
    value = weights[edges[places, steps]]
    value = np.where(edges[places, steps] == BYTES_EDGE, spelled[places - 1], value).tolist()
    steps, ends = (steps + 1).tolist(), np.searchsorted(places, np.arange(1, len(edges) + 1)).tolist()
    sums, at = [0.0], ends[0]
    for place in range(1, len(edges)):
        end = ends[place]
        if end - at == 1:
            sums.append(value[at] + sums[place - steps[at]])
        else:
            ways = [value[i] + sums[place - steps[i]] for i in range(at, end)]
            top = max(ways)
            sums.append(top + math.log(sum([math.exp(w - top) for w in ways])))
        at = end
    sums = np.concatenate([np.full(longest, -np.inf), sums])
    for begin in range(1, len(edges), LONG_BLOCK):
        here = np.arange(begin, min(begin + LONG_BLOCK, len(edges)))
        edge = edges[here]
        ways = weights[edge]
        ways[edge[:, 0] == BYTES_EDGE, 0] = spelled[here[edge[:, 0] == BYTES_EDGE] - 1]
        ways = np.where(edge == -1, -np.inf, ways + sums[here[:, None] + longest - np.arange(1, longest + 1)])
        parts = np.cumsum(np.exp(ways - ways.max(1)[:, None]), 1)
        draw[here] = parts / parts[:, -1:]


def encode(p: Pieces, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled ids of all texts behind each other, and where each text's ids begin (n + 1)."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    heads = before[offsets]
    full = np.flatnonzero(np.diff(heads) > 0)
    chars = np.where(chars == MARK, LITERAL, np.where(chars == 32, MARK, chars))
    chars = np.insert(chars, heads[full], MARK)
    heads = heads + np.concatenate([[0], np.cumsum(np.diff(heads) > 0)])
    mark = chars == MARK
    border = np.zeros(len(chars), bool)
    border[1:] = mark[1:] & ~mark[:-1]
    border[heads[full]] = True
    starts = np.flatnonzero(border)
    ends = np.append(starts[1:], len(chars))
    hashes = [Prefix(chars, base).ranges(starts, ends) for base in BASES]
    _, where, which = np.unique(hashes[0], return_index=True, return_inverse=True)
    if not np.array_equal(hashes[1], hashes[1][where][which]):
        _, where, which = np.unique(np.stack(hashes, 1), axis=0, return_index=True, return_inverse=True)
        which = which.ravel()
    sizes = (ends - starts)[where]
    total = np.cumsum(sizes)
    unit_chars = chars[np.repeat(starts[where] - (total - sizes), sizes) + np.arange(total[-1])]
    bases, edges, draw = lattice(p, unit_chars, sizes)
    owner = np.searchsorted(heads, starts, "right") - 1
    row_seed = mixed(keys.astype(np.int64).view(U64) + U64(seed) * U64(BASES[1]))
    base, slot, end = bases[which], bases[which] + (ends - starts), ends.copy()
    begin_of, salt = heads[owner], row_seed[owner]
    piece_at = np.full(len(chars), -1, np.int32)

    def drawn(slots: np.ndarray, places: np.ndarray, salts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length less one and id of the piece drawn at each slot, ``places`` characters into its text."""
        uniform = (mixed(salts + places.astype(U64) * U64(BASES[0])) >> U64(11)).astype(np.float64) * 2.0**-53
        k = np.minimum((draw[slots] <= uniform[:, None].astype(np.float32)).sum(1), p.longest - 1)
        chosen = edges[slots, k]
        wrong = chosen == -1
        if wrong.any():  # a draw just above the last running sum: take the last edge there is
            last = p.longest - 1 - np.argmax((edges[slots[wrong]] != -1)[:, ::-1], 1)
            k[wrong], chosen[wrong] = last, edges[slots[wrong], last]
        return k, chosen

    lengths = ends - starts
    for o in np.flatnonzero(lengths > LONG_UNIT).tolist():  # every place of a long unit draws at once, then the walk picks its places
        jump, drawn_there = [0], [np.zeros(1, np.int32)]
        for j in range(1, int(lengths[o]) + 1, LONG_BLOCK):
            inside = np.arange(j, min(j + LONG_BLOCK, int(lengths[o]) + 1))
            k, chosen = drawn(base[o] + inside, starts[o] + inside - begin_of[o], np.full(len(inside), salt[o]))
            jump += (k + 1).tolist()
            drawn_there.append(chosen)
        at, visited = int(lengths[o]), []
        while at > 0:
            visited.append(at)
            at -= jump[at]
        visited = np.array(visited)
        piece_at[starts[o] + visited - np.array(jump)[visited]] = np.concatenate(drawn_there)[visited]
    alive = np.flatnonzero(lengths <= LONG_UNIT)
    while len(alive):
        k, chosen = drawn(slot[alive], end[alive] - begin_of[alive], salt[alive])
        end[alive] -= k + 1
        slot[alive] -= k + 1
        piece_at[end[alive]] = chosen
        alive = alive[slot[alive] > base[alive]]
    begins = np.flatnonzero(piece_at != -1)
    chosen = piece_at[begins].astype(np.int64)
    spelled = chosen == BYTES_EDGE
    chars_there = np.where(chars[begins] == LITERAL, MARK, chars[begins])
    counts = np.where(spelled, utf8_sizes(chars_there), 1)
    ids = np.repeat(chosen, counts)
    if spelled.any():
        text = "".join(map(chr, chars_there[spelled].tolist()))
        ids[np.repeat(spelled, counts)] = p.byte_ids[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    placed = np.concatenate([[0], np.cumsum(counts)])
    return ids, placed[np.searchsorted(begins, heads)]


def decode(p: Pieces, ids: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of ids as UTF-8 bytes behind each other, and their offsets."""
    sizes = p.name_sizes[ids]
    placed = np.concatenate([[0], np.cumsum(sizes)])
    first = (p.name_ends - p.name_sizes)[ids]
    data = p.flat[np.repeat(first - placed[:-1], sizes) + np.arange(placed[-1])]
    offsets = placed[heads]
    full = np.flatnonzero(np.diff(offsets) > 0)
    data = np.delete(data, offsets[full])  # the mark in front
    return data, offsets - np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])


_pieces: dict[tuple[str, float], Pieces] = {}


def pieces(path: str, alpha: float) -> Pieces:
    """The vocabulary of this Python process."""
    if (path, alpha) not in _pieces:
        _pieces[path, alpha] = Pieces(path, alpha)
    return _pieces[path, alpha]


def same_texts(data: np.ndarray, offsets: np.ndarray, other: np.ndarray, other_offsets: np.ndarray) -> np.ndarray:
    """Which texts are equal byte for byte."""
    equal = np.diff(offsets) == np.diff(other_offsets)
    if equal.all():
        wrong = np.concatenate([[0], np.cumsum(data != other)])
        return wrong[offsets[1:]] == wrong[offsets[:-1]]
    for k in np.flatnonzero(equal):
        equal[k] = np.array_equal(data[offsets[k] : offsets[k + 1]], other[other_offsets[k] : other_offsets[k + 1]])
    return equal


def encode_texts(documents: DataFrame, path: str, alpha: float = 1.0, seed: int = 1, key: str = "doc_id") -> DataFrame:
    """``doc_id, ids, n_pieces, lossless``: sampled ids, and whether decoding them gave the text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path, alpha)
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                data, offsets = buffer_of(part.column("text"))
                keys = part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                ids, heads = encode(p, data, offsets, keys, seed)
                lossless = same_texts(data, offsets, *decode(p, ids, heads))
                lists = pa.ListArray.from_arrays(pa.array(heads, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(np.diff(heads)), pa.array(lossless)],
                    ["doc_id", "ids", "n_pieces", "lossless"],
                )

    narrow = documents.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, ids array<int>, n_pieces long, lossless boolean")


def decode_texts(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path, 1.0)
        for batch in batches:
            lists = batch.column("ids")
            heads = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            data, offsets = decode(p, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), heads)
            whole = data.tobytes()
            texts = [whole[a:b].decode() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
