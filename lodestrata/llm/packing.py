"""Operator 6: packing documents into sequences by bin completion over the histogram of lengths."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, bound_batches, by_bytes, flat, materialize, words

WINDOW = 2048
CACHE_WORDS = 1_500_000
FILLINGS = 20_000  # fillings looked at, after which bin completion keeps its best packing
_encoders: dict[str, Encoder] = {}


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + size), end to end."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Encoder:
    """Ids of whole texts, word by word through a bounded cache: the tokenizer never merges across ASCII white space.

    New words of plain Latin letters are cut into the tokenizer's own pieces, and all new pieces of a batch are encoded as
    one text; each piece ends in one end-of-word id, so the ids fall apart again. Other words, and those that may hold a
    special token's string, are encoded one by one."""

    PLAIN = re.compile(r"[\x21-\x7e\xa1-\u012f\u0131-\u024f]+")

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.piece = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        ends = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.closes = np.zeros(max(ends, default=0) + 1, bool)
        self.closes[ends] = True
        self.forget()

    def forget(self) -> None:
        """The cache: sorted codes of words, and where their ids lie in one flat array; about 40 bytes a word."""
        self.codes, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.array([x for i in ids for x in i], np.uint32), np.array([len(i) for i in ids], np.int64)

    def learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and the number of ids of each."""
        texts = [w.decode("utf-8", "replace") for w in new]
        plain = np.array([bool(self.PLAIN.fullmatch(t)) for t in texts], bool)
        cut = [self.piece.findall(t.lower()) for t, p in zip(texts, plain, strict=True) if p]
        every = [x for ps in cut for x in ps]
        fresh = list(dict.fromkeys(every))
        ids = np.array(self.tokenizer.encode_batch([" ".join(fresh)], add_special_tokens=False)[0].ids if fresh else [], np.int64)
        last = np.flatnonzero(self.closes[np.minimum(ids, len(self.closes) - 1)] & (ids < len(self.closes)))
        if len(last) == len(fresh) and (not fresh or last[-1] == len(ids) - 1):
            ids, size = ids.astype(np.uint32), np.diff(np.r_[-1, last])
        else:
            ids, size = self.one_by_one(fresh)
        index = dict(zip(fresh, range(len(fresh)), strict=True))
        at = np.fromiter(map(index.__getitem__, every), np.int64, len(every))
        easy = ids[spread((np.cumsum(size) - size)[at], size[at])]
        sizes = np.zeros(len(new), np.int64)
        sizes[plain] = np.bincount(np.repeat(np.arange(len(cut)), [len(ps) for ps in cut]), size[at], len(cut))
        if plain.all():
            return easy, sizes
        hard, hard_sizes = self.one_by_one([t for t, p in zip(texts, plain, strict=True) if not p])
        sizes[~plain] = hard_sizes
        out, owner = np.zeros(sizes.sum(), np.uint32), np.repeat(plain, sizes)
        out[owner], out[~owner] = easy, hard
        return out, sizes

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts that lie end to end in ``data``, and the number of ids of each text."""
        if b"<|" in data.tobytes():  # may be a special token's string: whole texts, as they are
            return self.one_by_one([data[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(off[:-1], off[1:], strict=True)])
        codes, s, e, first = words(data, off)
        distinct, at, inverse = np.unique(codes, return_index=True, return_inverse=True)
        if len(self.codes) > CACHE_WORDS:
            self.forget()
        spot = np.searchsorted(self.codes, distinct)
        known = self.codes[np.minimum(spot, len(self.codes) - 1)] == distinct if len(self.codes) else np.zeros(len(distinct), bool)
        if not known.all():
            low, new = LOWER[data], at[~known]
            ids, size = self.learn([low[i:j].tobytes() for i, j in zip(s[new], e[new], strict=True)])
            self.codes = np.insert(self.codes, spot[~known], distinct[~known])
            self.place = np.insert(self.place, spot[~known], len(self.size) + np.arange(len(new)))
            self.start = np.r_[self.start, len(self.flat) + np.cumsum(size) - size]
            self.size, self.flat = np.r_[self.size, size], np.r_[self.flat, ids]
            spot = np.searchsorted(self.codes, distinct)
        word = self.place[spot][inverse] if len(distinct) else np.zeros(0, np.int64)
        size = self.size[word]
        return self.flat[spread(self.start[word], size)], np.diff(np.r_[0, np.cumsum(size)][first])


def encoder(name: str) -> Encoder:
    if name not in _encoders:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if os.sep not in name:
            import public_tokenizers

            name_path = public_tokenizers.path(name)
        else:
            name_path = name
        _encoders[name] = Encoder(name_path)
    return _encoders[name]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing on a histogram: groups of equal bins, each a filling (size -> copies) and how many bins have it."""
    open_bins: dict[int, list[tuple[dict[int, int], int]]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_bins if r >= size), default=None)
            if room is None:
                each = min(capacity // size, left)
                bins = left // each
                open_bins.setdefault(capacity - each * size, []).append(({size: each}, bins))
                left -= bins * each
                continue
            filling, bins = open_bins[room].pop()
            each = min(room // size, left)
            used = min(bins, left // each)
            if used < bins:
                open_bins[room].append((filling, bins - used))
            if not open_bins[room]:
                del open_bins[room]
            open_bins.setdefault(room - each * size, []).append(({**filling, size: filling.get(size, 0) + each}, used))
            left -= used * each
    return [g for groups in open_bins.values() for g in groups]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that every packing needs: by volume, by dual feasible functions that count a size as floor((k + 1) size / capacity)
    kths of a bin, and by those that count sizes above capacity - t as full bins and drop those below t."""
    each = np.zeros(capacity + 1, np.int64)
    each[list(counts)] = list(counts.values())
    size = np.arange(capacity + 1)
    number, volume = np.r_[0, np.cumsum(each)], np.r_[0, np.cumsum(each * size)]
    t = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - t + 1]
    rest = volume[capacity - t + 1] - volume[t]
    best = max(-(-int(volume[-1]) // capacity), int((whole - (-rest // capacity)).max(initial=0)))
    return max(best, *(-(-int((each * (((k + 1) * size - 1).clip(0) // capacity)).sum()) // k) for k in range(1, 40)))


def completions(room: int, counts: dict[int, int], budget: list[int]):
    """Undominated fillings of ``room`` by remaining sizes, of any number of parts, least waste first, larger parts first. Each
    filling looked at takes one of ``budget``.

    Prefixes of the ascending sizes have their reachable sums as bits of one number, so the search for parts of a given sum
    never fails. A filling is dominated if some of its parts can be exchanged for one remaining size of at least their sum
    that still fits (no parts for any size that fits, too)."""
    sizes = sorted(s for s, c in counts.items() if c and s <= room)
    reach, mask = [1], (1 << room + 1) - 1
    for s in sizes:
        bits, left, step = reach[-1], min(counts[s], room // s), 1
        while left:
            n = min(step, left)
            bits |= bits << n * s & mask
            left, step = left - n, step * 2
        reach.append(bits)

    def parts(total: int, i: int):
        if not total:
            yield ()
        for j in range(min(i, bisect_right(sizes, total)), 0, -1):
            if not reach[j] >> total & 1:
                return
            s = sizes[j - 1]
            for c in range(min(counts[s], total // s), 0, -1):
                if reach[j - 1] >> total - c * s & 1:
                    for f in parts(total - c * s, j - 1):
                        yield (s,) * c + f

    def dominated(filling: tuple[int, ...], waste: int) -> bool:
        def fits(low: int, high: int) -> bool:
            k = bisect_left(sizes, low)
            while k < len(sizes) and sizes[k] <= high:
                if counts[sizes[k]] > filling.count(sizes[k]):
                    return True
                k += 1
            return False

        if fits(1, waste):
            return True
        sums = {(0, 0)}
        for s in filling:
            more = {(t + s, min(n + 1, 2)) for t, n in sums} - sums
            if any(fits(t + (n < 2), t + waste) for t, n in more):  # of one part only a larger one is better
                return True
            sums |= more
        return False

    for waste in range(room + 1):
        if reach[-1] >> room - waste & 1:
            for f in parts(room - waste, len(sizes)):
                if not budget[0]:
                    return
                budget[0] -= 1
                if not dominated(f, waste):
                    yield f


def largest_first(room: int, counts: dict[int, int]) -> tuple[int, ...]:
    """The filling of fewest parts: each as large as fits."""
    out: list[int] = []
    for s in sorted(counts, reverse=True):
        n = min(counts[s], room // s)
        out += [s] * n
        room -= n * s
    return tuple(out)


def bin_completion(counts: dict[int, int], capacity: int, fillings: int = FILLINGS) -> list[tuple[dict[int, int], int]]:
    """Branch and bound around the largest remaining size. The incumbent is best fit; a branch ends when its waste exceeds
    what one bin less would allow. Equal bins are filled together, so the work depends on the number of distinct sizes, not of
    documents.

    Dives come first, which follow one filling at each node: the fewest and largest parts for the first k groups of bins, then
    least waste (large documents that fill a bin badly whatever stands beside them go together, the others fill bins
    exactly), for 33 values of k and the 16 around the best. Then a search that follows the best filling of each node, and
    the best 4, 16, 64, ... in further rounds. It ends at the lower bound, when a round has left no filling out, or when
    ``fillings`` fillings have been looked at (the problem is NP-hard), with the best packing so far."""
    counts = {s: c for s, c in counts.items() if c}
    best = best_fit(counts, capacity)
    total, bound = sum(s * c for s, c in counts.items()), lower_bound(counts, capacity)
    number, budget = sum(m for _, m in best), [fillings]

    def fill(left: dict[int, int], filling: tuple[int, ...]) -> tuple[dict[int, int], dict[int, int], int]:
        """As many bins of one filling as the remaining documents allow: (the rest, the filling, bins)."""
        whole: dict[int, int] = {}
        for s in filling:
            whole[s] = whole.get(s, 0) + 1
        times = min(left[s] // k for s, k in whole.items())
        return {s: c - times * whole.get(s, 0) for s, c in left.items() if c - times * whole.get(s, 0)}, whole, times

    def dive(k: int) -> tuple[int, list, int]:
        left, groups, waste, bins = counts, [], 0, 0
        while left:
            if waste > (number - 1) * capacity - total or not budget[0]:
                return number, [], len(groups)
            top = max(left)
            rest = {s: c - (s == top) for s, c in left.items() if c > (s == top)}
            found = largest_first(capacity - top, rest) if len(groups) < k else next(completions(capacity - top, rest, budget), None)
            if found is None:
                return number, [], len(groups)
            left, whole, times = fill(left, (top, *found))
            groups.append((whole, times))
            bins, waste = bins + times, waste + times * (capacity - top - sum(found))
        return bins, groups, len(groups)

    def dives(tried: list[int]) -> int:
        nonlocal best, number
        at = 0
        for k in tried:
            if number <= bound:
                break
            bins, groups, _ = dive(k)
            if groups and bins < number:
                best, number, at = groups, bins, k
        return at

    if number > bound:
        depth = len(best)
        step = max(1, depth // 32)
        at = dives(list(range(0, depth + 1, step)))
        if step > 1:
            dives(sorted({max(0, at + i * step // 8) for i in range(-8, 9)} - {at}))
    width = 1
    while budget[0] and number > bound:
        stack, complete = [(counts, None, 0, 0)], True
        while stack and budget[0] and number > bound:
            left, path, waste, bins = stack.pop()
            if waste > (number - 1) * capacity - total:
                continue
            if not left:
                groups, number = [], bins
                while path:
                    groups.append(path[0])
                    path = path[1]
                best = groups
                continue
            top = max(left)
            rest = {s: c - (s == top) for s, c in left.items() if c > (s == top)}
            found = list(islice(completions(capacity - top, rest, budget), width + 1))
            complete &= len(found) <= width and budget[0] > 0
            for filling in reversed(found[:width]):
                after, whole, times = fill(left, (top, *filling))
                stack.append((after, ((whole, times), path), waste + times * (capacity - top - sum(filling)), bins + times))
        if complete:
            break
        width *= 4
    return best


def pieces_of(docs: DataFrame, tokenizer: str, window: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces: id, piece, start, length, ids_crc32. A null text is empty: its only id is the end."""

    def run(batches):
        code = encoder(tokenizer)
        for b in by_bytes(batches, "text"):
            ids, sizes = code.encode(*flat(b.column("text")))
            cuts = np.r_[0, np.cumsum(sizes)]
            rows = []
            for k, doc in enumerate(b.column("doc_id").to_pylist()):
                own = np.r_[ids[cuts[k] : cuts[k + 1]], np.uint32(end_id)].astype("<u4")
                for p, at in enumerate(range(0, len(own), window)):
                    part = own[at : at + window]
                    rows.append((doc, p, at, len(part), zlib.crc32(part.tobytes())))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    bound_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long").withColumnRenamed("doc_id", id_col)


def pack_sequences(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into as few sequences of at most ``window`` tokens as found; only longer documents are cut.

    The pieces' lengths have at most ``window`` distinct values, so their histogram is all that the driver sees. Bin
    completion turns it into fillings; each piece then finds its sequence and offset from its rank among the pieces of
    its length, which is computed in salted windows. Null and empty texts are one end token. Null and repeated ids are
    documents like any other; an empty table gives no rows; other columns are ignored.
    ``tokenizer`` is a file of the public tokenizers, or a path that every executor can open.
    """
    spark = docs.sparkSession
    pieces = materialize(pieces_of(docs, tokenizer, window, 0, id_col, text_col))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    n = sum(histogram.values())
    full = histogram.get(window, 0)
    fillings = bin_completion({s: c for s, c in histogram.items() if s != window}, window) + ([({window: 1}, full)] if full else [])
    taken, keys, table, sequence = dict.fromkeys(histogram, 0), [], [], 0
    for filling, times in fillings:
        offset = 0
        for size in sorted(filling, reverse=True):
            each = filling[size]
            keys.append((size << 44) + taken[size])
            table.append((taken[size], each, sequence, offset))
            taken[size] += each * times
            offset += size * each
        sequence += times
    order = np.argsort(np.array(keys, np.int64), kind="stable") if keys else np.zeros(0, np.int64)
    keys, table = np.array(keys, np.int64)[order], np.array(table, np.int64).reshape(-1, 4)[order]

    grain = max(512, n >> 16)
    salts = np.ones(window + 1, np.int64)
    for size, c in histogram.items():
        salts[size] = -(-c // grain)
    base = np.cumsum(salts) - salts

    def cell(batches):
        from .common import U, mix

        for b in batches:
            size = b.column("length").to_numpy()
            key = mix(b.column("ids_crc32").to_numpy().astype(np.uint64) * U(0x9E3779B97F4A7C15) + b.column("piece").to_numpy().astype(np.uint64))
            doc = np.nan_to_num(b.column(0).to_numpy(zero_copy_only=False)).astype(np.int64).astype(np.uint64)
            yield b.append_column("cell", pa.array(base[size] + (mix(key + doc * U(0xC2B2AE3D27D4EB4F)) % salts[size].astype(np.uint64)).astype(np.int64)))

    seated = pieces.mapInArrow(cell, f"{id_col} long, piece int, start long, length long, ids_crc32 long, cell long")
    sums = seated.groupBy("cell", "length").agg(F.count("*").alias("n")).collect()
    per_cell = np.zeros(int(salts.sum()), np.int64)
    for r in sums:
        per_cell[r.cell] = r.n
    before = np.cumsum(per_cell) - per_cell
    before -= np.repeat(before[base], salts)

    def place(batches):
        for b in batches:
            size, spot = b.column("length").to_numpy(), b.column("cell").to_numpy()
            rank = before[spot] + b.column("rn").to_numpy() - 1
            first, each, seq, off = table[np.searchsorted(keys, (size << 44) + rank, side="right") - 1].T
            out = [b.column(c) for c in (id_col, "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*out, pa.array(seq + (rank - first) // each), pa.array(off + (rank - first) % each * size)], [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = seated.withColumn("rn", F.row_number().over(Window.partitionBy("cell").orderBy(id_col, "piece", "ids_crc32")).cast("long"))
    return ranked.mapInArrow(place, f"{id_col} long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_sequences(spark.read.parquet(f"{sf_dir}/documents.parquet"))
