"""SentencePiece encoding and decoding, with sampled segmentations (operator 6).

A text is the product of the lattices of its words: no piece of the vocabulary runs from a letter into the next word
mark, so a segmentation of the text is one of each word. Pieces weigh by the rank of their score; the probability of a
segmentation is the product of its pieces' weights, normalised over all segmentations.

``k`` segmentations are drawn without replacement by Gumbel top-k, as an A* search over perturbed sets. The set of all
segmentations gets a Gumbel value of its log mass; its best member is a plain sample. The rest splits, by the first
decision that differs, into disjoint sets whose masses are known, whose values are Gumbels truncated at that of the
parent. The best set of all is opened next. So each step costs one pass over the text, whatever the number of
segmentations. A sample's inclusion score is the probability of being among the first k, given the (k+1)-th value.

Random numbers are a function of row key, sample and position: results don't depend on batches or partitions.
Texts of a batch are worked on together in numpy, ``BATCH_CHARS`` characters or one text at a time.

Defined cases: a null or empty text has one segmentation without pieces; fewer than ``k`` segmentations are all
returned, with inclusion 1; characters outside the vocabulary become bytes; white space of any kind and U+2581 survive the
round trip; repeated rows get the same samples; a null id has a key of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache
from itertools import repeat
from math import exp

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.base import mixed

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BATCH_CHARS = 1 << 19
MARK = "▁"
#: Stand-ins that no valid text holds: for a mark in the text itself, and between words.
OWN_MARK, BETWEEN = "\ud800", "\ud801"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Words whose lattices are kept, none of them longer than ``SHORT``, and their arcs (16 bytes each).
REMEMBERED, SHORT, ROOM = 120_000, 64, 3_000_000
ARENA = {"first": np.int64, "begin": np.int64, "stop": bool, "end": np.int32, "piece": np.int32, "log": np.float64}
LOOKED, SHIFT = 18, np.uint64(64 - 18)
FACTOR = 0x5851F42D4C957F2D  # odd, so that it has an inverse
BYTES = 1 << 30  # with a code point added, an arc stands for that character written as bytes


def prefixes(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, and sums and factors that give the hash of any part: (sums[b] - sums[a]) * factors[a], modulo 2**64."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    powers, inverse = (np.cumprod(np.r_[np.uint64(1), np.full(len(codes), b, np.uint64)]) for b in (FACTOR, pow(FACTOR, -1, 1 << 64)))
    return codes, np.r_[np.uint64(0), np.cumsum(mixed(codes) * powers[:-1])], inverse


class Vocabulary:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        weight = np.zeros(size)
        by_score = sorted(plain, key=lambda i: -model.get_score(i))
        weight[by_score] = 1 / (np.arange(len(by_score)) + 10)
        weight[list(self.bytes_of)] = 1 / (size + 10)
        with np.errstate(divide="ignore"):
            self.log = np.log(weight / weight.sum())
        self.byte_log = float(self.log[self.byte_ids[0]])
        self.lengths = np.array([len(p) for p in self.pieces])
        _, sums, back = prefixes("".join(self.pieces[i] for i in plain))
        ends = np.cumsum(self.lengths[plain])
        hashes = (sums[ends] - sums[ends - self.lengths[plain]]) * back[ends - self.lengths[plain]]
        order = np.argsort(hashes)
        self.hashes, self.hashed = np.append(hashes[order], np.uint64(2**64 - 1)), np.append(np.array(plain, np.int32)[order], np.int32(0))
        self.place = np.searchsorted(hashes[order], np.arange(1 << LOOKED, dtype=np.uint64) << SHIFT).astype(np.int32)  # where hashes that begin so are
        self.looks = self._looks(sums, back, ends)
        self.number: dict[str, int] = {}  # words whose lattices are kept, see Lattice
        self.kept, self.arena = (0, 0, 0), {name: np.zeros(0, kind) for name, kind in ARENA.items()}
        # A byte below 128 is a character of its own; the others come in runs.
        self.written = [chr(self.bytes_of[i]) if i in self.bytes_of else p.replace(MARK, " ") for i, p in enumerate(self.pieces)]
        self.in_run = np.array([self.bytes_of.get(i, 0) > 127 for i in range(size)])
        self.byte_id = np.array([self.byte_ids[b] for b in range(256)], np.int32)

    def _looks(self, sums: np.ndarray, back: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Per length n from 0 on, by the leading bits of a hash: 1 where a piece of n characters has it, 2 (added) where the first n of a longer one have it.

        A mark too many only costs a look.
        """
        lengths = np.diff(np.r_[0, ends])
        out = []
        for n in range(int(lengths.max(initial=0)) + 1):
            marks = np.zeros(1 << LOOKED, np.uint8)
            for bit, chosen in ((1, lengths == n), (2, lengths > n)):
                first = (ends - lengths)[chosen]
                marks[(sums[first + n] - sums[first]) * back[first] >> SHIFT] |= np.uint8(bit)
            out.append(marks)
        return out

    def found(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are those of pieces, and these pieces."""
        place = self.place.take((hashed >> SHIFT).astype(np.int64))
        some = np.flatnonzero(self.hashes.take(place) < hashed)
        while len(some):  # hashes that begin alike lie in their order, the last one is a bar
            place[some] += 1
            some = some[self.hashes.take(place[some]) < hashed[some]]
        hit = np.flatnonzero((self.hashes.take(place) == hashed) & (place < len(self.hashes) - 1))
        return hit, self.hashed.take(place[hit])

    @property
    def met(self) -> dict[str, tuple[bytes, bytes]]:
        """The words whose lattices are kept, with the pieces and log probabilities of their arcs."""
        piece, log = self.arena["piece"], self.arena["log"]
        starts = self.arena["begin"][self.arena["first"][:self.kept[0]]]
        return {w: (piece[a:b].tobytes(), log[a:b].tobytes()) for w, a, b in zip(self.number, starts, np.append(starts[1:], self.kept[2]))}

    def decode(self, ids: np.ndarray) -> str:
        """The text of any segmentation; the mark that begins every text goes."""
        runs = self.in_run[ids]
        if not runs.any():
            return "".join(map(self.written.__getitem__, ids.tolist()))[1:]
        out, pending = [], bytearray()
        for i, held in zip(ids.tolist(), runs.tolist()):
            if held:
                pending.append(self.bytes_of[i])
                continue
            if pending:
                out.append(pending.decode(errors="replace"))
                pending = bytearray()
            out.append(self.written[i])
        out.append(pending.decode(errors="replace"))
        return "".join(out)[1:]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def words_of(text: str) -> list[str]:
    if not text:
        return []
    text = text.replace(MARK, OWN_MARK)
    if "  " in text or text[0] == " " or text[-1] == " ":
        return WORD.findall(MARK + text.replace(" ", MARK))
    return [MARK + w for w in text.split(" ")]


def uniform(x: np.ndarray) -> np.ndarray:
    """From the open interval (0, 1)."""
    return ((mixed(x) >> np.uint64(12)).astype(np.float64) + 0.5) / 2**52


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0] + 1, ... of all runs one after another."""
    total = int(sizes.sum())
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return np.arange(total) + shift


def behind(kept: np.ndarray, n: int, new: np.ndarray) -> np.ndarray:
    """The first ``n`` values and then the new ones, in the same array where it has the room and isn't far too large."""
    size = n + len(new)
    if not size <= len(kept) <= 4 * size + (1 << 20):
        kept, old = np.empty(size + size // 4, kept.dtype), kept
        kept[:n] = old[:n]
    kept[n:size] = new
    return kept


class Lattice:
    """The lattices of words. Nodes are places in the words, one word after another; arcs are pieces, sorted by the node they leave, likely ones first.

    They lie in the arrays of the vocabulary: first those of words kept from former batches, then those of new words. What
    isn't kept is overwritten by the next lattice.
    """

    def __init__(self, words: list[str], v: Vocabulary):
        self.v = v
        number, nodes, arcs = v.kept
        self.word = np.fromiter(map(v.number.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(self.word < 0)
        found = [words[i] for i in missing.tolist()]
        new = sorted(dict.fromkeys(found), key=lambda w: len(w) > SHORT)
        index = dict(zip(new, range(number, number + len(new))))
        self.word[missing] = np.fromiter(map(index.__getitem__, found), np.int64, len(found))
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        first = np.cumsum(lengths + 1) - lengths - 1
        begin, end, piece, log = _arcs(new, v, first, lengths)
        stop = np.zeros(len(begin), bool)
        stop[first + lengths] = True
        for name, n, values in (("first", number, first + nodes), ("begin", nodes, begin + arcs), ("stop", nodes, stop), ("end", arcs, end + nodes), ("piece", arcs, piece), ("log", arcs, log)):
            v.arena[name] = behind(v.arena[name], n, values)
        self.first, self.begin, self.stop, self.end, self.piece, self.log = (
            v.arena[name][:n] for name, n in zip(ARENA, [number + len(new), *[nodes + len(begin)] * 2, *[arcs + len(end)] * 3])
        )
        # Short words are kept as long as there is room.
        ends = np.append(begin[first[1:]], len(end)) if len(new) else begin
        keep = int(min((lengths <= SHORT).sum(), max(REMEMBERED - number, 0), np.searchsorted(ends, ROOM - arcs, side="right")))
        if keep:
            v.number.update(zip(new[:keep], range(number, number + keep)))
            v.kept = number + keep, nodes + int(first[keep - 1] + lengths[keep - 1]) + 1, arcs + int(ends[keep - 1])

    @property
    def start(self) -> np.ndarray:
        """The node that each arc leaves."""
        return np.repeat(np.arange(len(self.begin)), np.diff(np.append(self.begin, len(self.end))))

    def left(self, arc: int) -> int:
        """The node that an arc leaves."""
        return int(np.searchsorted(self.begin, arc, side="right")) - 1

    def sample(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A free sample per word given: all arcs one after another, and how many each word has."""
        node, active, steps = self.first.take(self.word), np.arange(len(seeds)), []
        sizes = np.zeros(len(seeds), np.int64)
        while len(active):
            left = uniform(seeds.take(active) + np.uint64(len(steps) * 0x9E3779B9))
            arc, last = self.begin.take(node), self.begin.take(node + 1) - 1
            some = np.flatnonzero(arc < last)
            while len(some):  # from the likeliest arc on, until the random number is used up
                at = arc.take(some)
                rest = left.take(some) - np.exp(self.log.take(at))
                go = np.flatnonzero((rest >= 0) & (at < last.take(some)))
                some = some.take(go)
                left[some] = rest.take(go)
                arc[some] += 1
            steps.append((active, arc))
            sizes[active] += 1
            node = self.end.take(arc)
            going = np.flatnonzero(~self.stop.take(node))
            active, node = active.take(going), node.take(going)
        place = np.cumsum(sizes) - sizes
        arcs = np.zeros(int(sizes.sum()), np.int64)
        for k, (who, arc) in enumerate(steps):
            arcs[place.take(who) + k] = arc
        return arcs, sizes

    def ids(self, arcs: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of arcs, and where among them lie the bounds between arcs."""
        out = self.piece.take(arcs)
        odd = np.flatnonzero(out >= BYTES)
        if not len(odd):
            return out, bounds
        codes = out[odd] - BYTES
        codes[codes == ord(OWN_MARK)] = ord(MARK)
        counts = np.ones(len(out), np.int64)
        counts[odd] = bytes_in(codes)
        out = np.repeat(out, counts)
        out[out >= BYTES] = self.v.byte_id.take(np.frombuffer("".join(map(chr, codes.tolist())).encode(), np.uint8))
        return out, np.append(0, np.cumsum(counts))[bounds]


def bytes_in(codes: np.ndarray) -> np.ndarray:
    """How many bytes characters have in UTF-8."""
    return 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)


def _arcs(words: list[str], v: Vocabulary, first: np.ndarray, lengths: np.ndarray):
    """Arcs of new words: the first arc per node; end, piece and log probability given the start per arc."""
    joined = "".join([w + BETWEEN for w in words])
    codes, sums, back = prefixes(joined)
    at, starts, ends, pieces, ranks = np.arange(len(joined)), [], [], [], []
    many = np.zeros(len(joined), np.int64)  # arcs per node; they are found in the order of their lengths
    odd = np.zeros(0, np.int64)
    for n in range(1, int(min(lengths.max(initial=0), v.lengths.max())) + 1):
        at = at[:np.searchsorted(at, len(joined) - n, side="right")]
        hashed = (sums.take(at + n) - sums.take(at)) * back.take(at)
        look = v.looks[n].take((hashed >> SHIFT).astype(np.int64))
        some = np.flatnonzero(look & 1)
        hit, piece = v.found(hashed.take(some))
        hit = at.take(some.take(hit))
        for values, x in ((starts, hit), (ends, hit + n), (pieces, piece), (ranks, many.take(hit))):
            values.append(x)
        many[hit] += 1
        if n == 1:  # characters that aren't pieces
            odd = np.flatnonzero((many == 0) & (codes != ord(BETWEEN)))
        at = at.take(np.flatnonzero(look & 2))  # places where a longer piece may begin
    written = codes[odd].astype(np.int64)
    starts, ends, ranks = (np.concatenate([*x, y]) for x, y in ((starts, odd), (ends, odd + 1), (ranks, many[odd])))
    log = np.concatenate([*(v.log.take(x) for x in pieces), v.byte_log * bytes_in(np.where(written == ord(OWN_MARK), ord(MARK), written))])
    pieces = np.concatenate([*pieces, (written + BYTES).astype(np.int32)])
    many[odd] += 1
    begin = np.cumsum(many) - many
    place = begin.take(starts) + ranks
    end, piece, prior = (np.empty(len(x), x.dtype) for x in (ends, pieces, log))
    end[place], piece[place], prior[place] = ends, pieces, log
    start = np.repeat(np.arange(len(joined)), many)
    # Log mass of all ways from a node to the end of its word, nearest nodes first.
    far = (np.repeat(first + lengths, lengths + 1) - np.arange(len(joined))).take(start)
    furthest = int(far.max(initial=0))
    order = np.argsort(far.astype(np.uint16) if furthest < 1 << 16 else far, kind="stable")  # 16 bits are sorted by radix
    mass = np.full(len(joined), -np.inf)
    mass[first + lengths] = 0.0
    s, e, g = start.take(order), end.take(order), prior.take(order)
    bounds = np.append(0, np.cumsum(np.bincount(far, minlength=furthest + 1)))[1:].tolist()
    heads = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else order
    cuts = np.searchsorted(heads, bounds).tolist()
    for a, b, i, j in zip(bounds[:-1], bounds[1:], cuts[:-1], cuts[1:]):
        if b > a:
            mass[s.take(heads[i:j])] = np.logaddexp.reduceat(g[a:b] + mass.take(e[a:b]), heads[i:j] - a)
    log = np.minimum(prior + mass.take(end) - mass.take(start), 0.0)
    # A node with one way on: its log probability is zero, whatever the sums above were rounded to.
    log[many.take(start) == 1] = 0.0
    # By node, then log probability, then length. The bits of a positive number of 32 bits are in its order.
    bits = np.abs(log).astype(np.float32).view(np.uint32).astype(np.int64)
    rank = np.arange(len(start)) - begin.take(start)
    order = np.argsort((start << 36) + (bits << 5) + rank) if len(joined) < 1 << 27 and many.max(initial=0) <= 32 else np.lexsort((rank, bits, start))
    return begin, end.take(order), piece.take(order), log.take(order)


def log_rest(log: np.ndarray) -> np.ndarray:
    """log(1 - exp(log)), minus infinity where nothing is left."""
    with np.errstate(divide="ignore"):
        return np.log(-np.expm1(log))


#: The greatest Gumbel value of a 52-bit uniform number; decisions looked at together, and texts.
HIGHEST, STEP, TOGETHER = 37.0, 200, 512


class _Sample:
    """A drawn segmentation of one text: its arcs and value, and the sets that remain beside it."""

    def __init__(self, arcs: np.ndarray, sizes: np.ndarray, value: float, branch: int, barred: tuple[int, ...], salt: int):
        self.arcs, self.sizes, self.value, self.branch, self.barred, self.salt = arcs, sizes, value, branch, barred, salt
        self.log, self.sets = 0.0, np.zeros(0)

    def best(self) -> None:
        i = int(self.sets.argmax()) if len(self.sets) else 0
        self.at, self.top = self.branch + i, float(self.sets[i]) if len(self.sets) else -np.inf

    def open(self) -> None:
        """Take the best set out."""
        self.sets[self.at - self.branch] = -np.inf
        self.best()


def _beside(lattice: Lattice, drawn: list[_Sample], needed: int) -> None:
    """The sets beside each of the samples, and the sum of its logs.

    Sets that begin ever later have ever less mass. Those whose mass can't reach the best values so far with the highest
    random number, whatever they hold, are never opened nor second: the search stops there.
    """
    lengths = np.array([len(x.arcs) for x in drawn])
    first = np.cumsum(lengths) - lengths
    log = lattice.log.take(np.concatenate([x.arcs for x in drawn]))
    value, branch = np.array([x.value for x in drawn]), np.array([x.branch for x in drawn])
    salt = np.array([x.salt for x in drawn], np.uint64)
    for x, total in zip(drawn, np.add.reduceat(log, first).tolist()):
        x.log = total
    before = np.array([log[a:a + b].sum() for a, b in zip(first.tolist(), branch.tolist())])
    best, parts = np.full((len(drawn), needed), -np.inf), [[] for _ in drawn]
    active, done = np.flatnonzero(branch < lengths), 0
    while len(active):
        begin = branch[active] + done
        left = lengths[active] - begin
        step = np.arange(min(STEP, int(left.max())))
        some = log.take(np.minimum((first[active] + begin)[:, None] + step, len(log) - 1))
        some[step >= left[:, None]] = 0.0  # nothing is left beside a sure decision
        rest = log_rest(some)
        if not done:
            for row, d in enumerate(active.tolist()):
                if drawn[d].barred:
                    rest[row, 0] = _not_barred(lattice, drawn[d])
        noise = uniform((salt[active] + begin.astype(np.uint64))[:, None] + step.astype(np.uint64))
        sums = np.cumsum(some, axis=1)
        loose = sums - some + before[active, None] + rest - np.log(-np.log(noise))
        sets = -np.logaddexp(-value[active, None], -loose)  # minus infinity stays so
        for d, found, n in zip(active.tolist(), sets, left.tolist()):
            parts[d].append(found[:n])
        before[active] += sums[:, -1]
        best[active] = np.partition(np.concatenate([best[active], loose], axis=1), -needed, axis=1)[:, -needed:]
        active = active[(left > STEP) & ~(before[active] + HIGHEST < best[active].min(axis=1))]
        done += STEP
    for x, found in zip(drawn, parts):
        x.sets = np.concatenate(found) if found else np.zeros(0)
        x.best()


def _not_barred(lattice: Lattice, x: _Sample) -> float:
    """Log mass of the ways on from where a sample branches, without the barred ones and its own."""
    shut, node = [*x.barred, int(x.arcs[x.branch])], lattice.left(int(x.arcs[x.branch]))
    left = 1.0 - float(np.exp(lattice.log[shut]).sum())
    return np.log(left) if len(shut) < lattice.begin[node + 1] - lattice.begin[node] and left > 0 else -np.inf


def row_seed(doc: int | None, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{seed}:{doc}".encode())


def segmentations(texts: list[str], seeds: list[int], k: int, v: Vocabulary) -> list[list[tuple[np.ndarray, float, float]]]:
    """Per text up to ``k`` distinct segmentations in the order drawn: (ids, log probability, inclusion score)."""
    words: list[str] = []
    begins = [0]
    for text in texts:
        words += words_of(text)
        begins.append(len(words))
    if not words:
        return [[(np.zeros(0, np.int32), 0.0, 1.0)] for _ in texts]
    lattice, sizes = Lattice(words, v), np.diff(begins)
    base = mixed(np.repeat(np.array(seeds, np.uint64), sizes) + ragged(np.zeros(len(sizes), np.int64), sizes).astype(np.uint64))
    values = (-np.log(-np.log(uniform(np.array(seeds, np.uint64) + np.uint64(1))))).tolist()
    samples: list[list[_Sample]] = [[] for _ in texts]
    for draw in range(k):
        arcs, lengths = lattice.sample(mixed(base + np.uint64(draw)))
        at = np.append(0, np.cumsum(lengths))[begins].tolist()
        drawn: list[tuple[int, _Sample]] = []
        for d in np.flatnonzero(sizes).tolist():
            own, own_sizes = arcs[at[d]:at[d + 1]], lengths[begins[d]:begins[d + 1]]
            value, branch, barred = values[d], 0, ()
            if draw:
                parent = max(samples[d], key=lambda s: s.top)
                if np.isneginf(parent.top):
                    continue
                value, branch = parent.top, parent.at
                barred = ((*parent.barred, int(parent.arcs[branch])) if parent.barred and branch == parent.branch else (int(parent.arcs[branch]),))
                own, own_sizes = _branched(lattice, parent, branch, barred, own, own_sizes, seeds[d], draw)
                parent.open()
            drawn.append((d, _Sample(own, own_sizes, value, branch, barred, xxhash.xxh3_64_intdigest(b"%d:%d" % (seeds[d], draw)) >> 1)))
        for a in range(0, len(drawn), TOGETHER):
            _beside(lattice, [x for _, x in drawn[a:a + TOGETHER]], k - draw)
        for d, x in drawn:
            samples[d].append(x)
    every = [x.arcs for found in samples for x in found]
    ids, bounds = lattice.ids(np.concatenate(every), np.append(0, np.cumsum([len(x) for x in every])))
    spans, out = iter(zip(bounds[:-1].tolist(), bounds[1:].tolist())), []
    for drawn in samples:
        if not drawn:
            out.append([(np.zeros(0, np.int32), 0.0, 1.0)])
            continue
        threshold = max(s.top for s in drawn)
        out.append([(ids[slice(*next(spans))], s.log, 1.0 if np.isneginf(threshold) else float(-np.expm1(-np.exp(min(s.log - threshold, 700.0))))) for s in drawn])
    return out


def random_numbers(seed: int, draw: int) -> random.Random:
    return random.Random(seed * 1_000_003 + draw)


def _branched(lattice: Lattice, parent: _Sample, branch: int, barred: tuple[int, ...], fresh: np.ndarray, fresh_sizes: np.ndarray, seed: int, draw: int) -> tuple[np.ndarray, np.ndarray]:
    """The parent up to ``branch``, an arc that isn't barred, a free way to the end of the word, and the fresh sample from there."""
    ends = np.cumsum(parent.sizes)
    w = int(np.searchsorted(ends, branch, side="right"))
    node = lattice.left(int(parent.arcs[branch]))
    tail: list[int] = []
    numbers = random_numbers(seed, draw)
    while not lattice.stop[node]:
        options = [i for i in range(lattice.begin[node], lattice.begin[node + 1]) if tail or i not in barred]
        logs = lattice.log[options[0]:options[-1] + 1].tolist()
        logs = [logs[i - options[0]] for i in options]
        weights = [exp(x - max(logs)) for x in logs]
        tail.append(numbers.choices(options, weights)[0])
        node = int(lattice.end[tail[-1]])
    begin = int(ends[w] - parent.sizes[w])
    arcs = np.concatenate([parent.arcs[:branch], np.array(tail, np.int64), fresh[int(fresh_sizes[:w + 1].sum()):]])
    return arcs, np.concatenate([parent.sizes[:w], [branch - begin + len(tail)], fresh_sizes[w + 1:]])


SAMPLES = "doc_id long, sample int, ids array<int>, log_prob double, inclusion double, round_trip boolean"


def _encoded(batches, k: int, seed: int, path: str):
    v = vocabulary(path)
    for batch in batches:
        docs = batch.column(0).to_pylist()
        a = 0
        while a < len(docs):
            texts, chars = [], 0
            while a + len(texts) < len(docs) and (not texts or chars < BATCH_CHARS):
                texts.append(batch.column(1)[a + len(texts)].as_py() or "")
                chars += len(texts[-1])
            own = docs[a:a + len(texts)]
            drawn = segmentations(texts, [row_seed(d, seed) for d in own], k, v)
            flat = [(d, i, ids, log, share, v.decode(ids) == t) for d, t, samples in zip(own, texts, drawn) for i, (ids, log, share) in enumerate(samples)]
            lengths = np.array([len(r[2]) for r in flat])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(np.concatenate([r[2] for r in flat]), pa.int32()))
            column = lambda i, kind: pa.array([r[i] for r in flat], kind)
            yield pa.RecordBatch.from_arrays(
                [column(0, pa.int64()), column(1, pa.int32()), lists, column(3, pa.float64()), column(4, pa.float64()), column(5, pa.bool_())],
                ["doc_id", "sample", "ids", "log_prob", "inclusion", "round_trip"],
            )
            a += len(texts)


def encoded(documents: DataFrame, k: int = 2, seed: int = 0, path: str = VOCABULARY) -> DataFrame:
    """A row per sampled segmentation: doc_id, sample (0 first), ids, log_prob, inclusion, and whether decoding gives the text."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(lambda b: _encoded(b, k, seed, path), SAMPLES)


def _decoded(batches, path: str):
    v = vocabulary(path)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([v.decode(np.array(x.as_py() or [], np.int64)) for x in batch.columns[-1]], pa.string())], ["doc_id", "sample", "text"])


def decoded(segmented: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, sample, text) of rows with ids."""
    return segmented.select("doc_id", "sample", "ids").mapInArrow(lambda b: _decoded(b, path), "doc_id long, sample int, text string")
