"""SentencePiece encoding and decoding with the N best segmentations.

The best segmentation of a text maximises the sum of the scores of its pieces. No piece joins white space to what is
before it, so a lattice falls apart at white space, and every distinct part of a task is solved once: a forward Viterbi
pass and, where more than the best is wanted, a backward A* search whose exact heuristic are the forward scores.
The N best of a text come from the N best of the few parts whose second-best segmentation costs least.
"""

from __future__ import annotations

import heapq
import re
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, whole_text
from .shingles import Numbers

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the format: an unknown character costs so much more than the worst piece
PARTS_HELD = 1 << 18
_M = np.uint64(0x9E3779B97F4A7C15)


class PieceLattice:
    """Pieces and scores of a model file, and segmentations of parts of text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = self.model.get_piece_size()
        self.pieces = [self.model.id_to_piece(i) for i in range(count)]
        usable = [i for i in range(count) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i))]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(count) if self.model.is_byte(i)}
        self.scores = np.array([self.model.get_score(i) for i in range(count)])
        self.ids = {self.pieces[i]: i for i in usable}
        self.unknown = self.scores[usable].min() - UNKNOWN_PENALTY
        self.longest = max(map(len, self.ids))
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece joins white space to what is before it")
        self.alone = "\n" not in inside
        self.cut = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if self.alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.by_length = {}
        for n in range(1, self.longest + 1):
            found = [(p, i) for p, i in self.ids.items() if len(p) == n]
            keys = self._hashes(np.array([[ord(c) for c in p] for p, _ in found], dtype=np.uint64).reshape(len(found), n), n)[:, 0]
            order = np.argsort(keys)
            self.by_length[n] = keys[order], np.array([i for _, i in found], dtype=np.int64)[order]

    @staticmethod
    def _hashes(points: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n code points from each place of each row."""
        width = points.shape[1] - n + 1
        mixed = np.full((len(points), width), n, dtype=np.uint64)
        for i in range(n):
            mixed = (mixed ^ points[:, i:i + width]) * _M
            mixed ^= mixed >> np.uint64(32)
        return mixed

    def _edges(self, points: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By length: (piece id, score) from each place of each row of code points, -1 where there is no piece."""
        out = {}
        for n in range(1, min(self.longest, points.shape[1]) + 1):
            keys, ids = self.by_length[n]
            if not len(keys):
                continue
            hashed = self._hashes(points, n)
            at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
            piece = np.where(keys[at] == hashed, ids[at], -1)
            score = np.where(piece >= 0, self.scores[piece], -np.inf)
            if n == 1:
                score = np.where(piece >= 0, score, self.unknown)
            elif not (piece >= 0).any():
                continue
            out[n] = piece, score
        return out

    def solve(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(best score, cost of the second best, ids of the best) of many parts; equal scores go to the longer last
        piece. The second best must leave the best path by some edge, and the forward and backward scores of the edges
        off the best path give the best of those."""
        best, second, ids = np.zeros(len(parts)), np.full(len(parts), np.inf), [b""] * len(parts)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        for length in np.unique(lengths[lengths > 0]):
            members = np.flatnonzero(lengths == length)
            for lo in range(0, len(members), max(1, 65_536 // int(length))):
                some = members[lo:lo + max(1, 65_536 // int(length))]
                points = np.frombuffer("".join(parts[i] for i in some).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                self._solve_equal(points.reshape(len(some), length).astype(np.uint64), some, parts, best, second, ids)
        return best, second, ids

    def _solve_equal(self, points, some, parts, best, second, ids) -> None:
        rows, length = points.shape
        edges = self._edges(points)
        forward, backward = np.full((rows, length + 1), -np.inf), np.full((rows, length + 1), -np.inf)
        forward[:, 0] = backward[:, length] = 0
        step = np.zeros((rows, length + 1), dtype=np.int64)
        for j in range(1, length + 1):
            for n in sorted((n for n in edges if n <= j), reverse=True):
                value = forward[:, j - n] + edges[n][1][:, j - n]
                better = value > forward[:, j]
                forward[better, j] = value[better]
                step[better, j] = n
        for i in range(length - 1, -1, -1):
            for n in edges:
                if i + n <= length:
                    np.maximum(backward[:, i], edges[n][1][:, i] + backward[:, i + n], out=backward[:, i])
        at, row = np.full(rows, length), np.arange(rows)
        used = {n: np.zeros(edges[n][1].shape, dtype=bool) for n in edges}
        paths: list[list[int]] = [[] for _ in range(rows)]
        while (at > 0).any():
            back = step[row, at]
            for n in edges:
                here = np.flatnonzero((back == n) & (at > 0))
                places = at[here] - n
                used[n][here, places] = True
                for r, p, i in zip(here.tolist(), edges[n][0][here, places].tolist(), places.tolist()):
                    paths[r].append(p if p >= 0 else -1 - i)
            at = at - back
        other = np.full(rows, -np.inf)
        for n, (_, score) in edges.items():
            through = forward[:, :length - n + 1] + score + backward[:, n:]
            other = np.maximum(other, np.where(used[n], -np.inf, through).max(axis=1))
        best[some], second[some] = forward[:, length], forward[:, length] - other
        for r, i in enumerate(some):
            path = paths[r][::-1]
            if min(path) < 0:
                path = [x for p in path for x in ([p] if p >= 0 else self._spelled(parts[i][-1 - p]))]
            ids[i] = array("I", path).tobytes()

    def _spelled(self, char: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, or the unknown piece."""
        data = char.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in data] if all(b in self.bytes for b in data) else [self.model.unk_id()]

    def n_best(self, part: str, n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations of a part, best first: A* from the end, with the forward scores as heuristic. They are
        exact, so the paths leave the queue in order of their whole score."""
        length = len(part)
        ending: list[list[tuple[int, float, int]]] = [[] for _ in range(length + 1)]
        forward = [0.0] + [-np.inf] * length
        for j in range(1, length + 1):
            for size in range(min(self.longest, j), 0, -1):
                piece = self.ids.get(part[j - size:j], -1)
                if piece < 0 and size > 1:
                    continue
                score = float(self.scores[piece]) if piece >= 0 else self.unknown
                ending[j].append((j - size, score, piece))
                forward[j] = max(forward[j], forward[j - size] + score)
        queue, made, found = [(-forward[length], 0, length, 0.0, ())], 1, []
        while queue and len(found) < n:
            _, _, at, tail, path = heapq.heappop(queue)
            if at == 0:
                ids = [x for start, piece in path for x in ([piece] if piece >= 0 else self._spelled(part[start]))]
                found.append((tail, array("I", ids).tobytes()))
                continue
            for start, score, piece in ending[at]:
                heapq.heappush(queue, (-(forward[start] + score + tail), made, start, score + tail, ((start, piece), *path)))
                made += 1
        return found

    def normal(self, text: str) -> str:
        return self.model.normalize(text)

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, dtype=np.uint32).tolist())


def combine(choices: list[list[float]], n: int) -> list[list[int]]:
    """The n cheapest ways to take one of each list of costs (each ascending from 0), as ranks."""
    start = (0,) * len(choices)
    queue, seen, out = [(0.0, start)], {start}, []
    while queue and len(out) < n:
        cost, ranks = heapq.heappop(queue)
        out.append(list(ranks))
        for i, r in enumerate(ranks):
            if r + 1 < len(choices[i]):
                more = (*ranks[:i], r + 1, *ranks[i + 1:])
                if more not in seen:
                    seen.add(more)
                    heapq.heappush(queue, (cost - choices[i][r] + choices[i][r + 1], more))
    return out


class SentenceEncoder:
    """Segmentations of whole texts; parts are solved once and held up to a fixed number."""

    def __init__(self, path: str, held: int = PARTS_HELD):
        self.lattice, self.held = PieceLattice(path), held
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.parts: list[str] = []
        self.best, self.second = np.zeros(0), np.zeros(0)
        self.ids: list[bytes] = []
        self.more: dict[int, list[tuple[float, bytes]]] = {}

    def encode(self, texts: list[str], n: int) -> list[list[tuple[float, bytes]]]:
        """For each text its n best segmentations (score, ids as 32-bit integers), best first; an empty text has the empty one."""
        if len(self.numbers) > self.held:
            self._forget()
        cut = [self.numbers.of(self.lattice.cut.findall(self.lattice.normal(t))) for t in texts]
        if fresh := self.numbers.fresh:
            best, second, ids = self.lattice.solve(fresh)
            self.best, self.second = np.concatenate((self.best, best)), np.concatenate((self.second, second))
            self.ids += ids
            self.parts += fresh
            fresh.clear()
        return [self._whole(parts, n) for parts in cut]

    def _whole(self, parts: np.ndarray, n: int) -> list[tuple[float, bytes]]:
        costs = self.second[parts]
        some = min(n - 1, len(parts))
        turn = np.argpartition(costs, some - 1)[:some] if some else np.zeros(0, np.int64)
        turn = np.sort(turn[np.isfinite(costs[turn])])
        lists = []
        for place in turn:
            part = int(parts[place])
            if len(self.more.get(part, ())) < n:
                self.more[part] = self.lattice.n_best(self.parts[part], n)
            lists.append(self.more[part])
        score, out = float(self.best[parts].sum()), []
        pieces = [self.ids[p] for p in parts.tolist()]
        for ranks in combine([[made[0][0] - s for s, _ in made] for made in lists], n):
            changed, total = list(pieces), score
            for place, made, r in zip(turn.tolist(), lists, ranks):
                if r:
                    changed[place], total = made[r][1], total - made[0][0] + made[r][0]
            out.append((total, b"".join(changed)))
        return out


def segment_documents(docs: DataFrame, model: str, n_best: int = 2) -> DataFrame:
    """(doc_id, rank, score, ids, text) of the n_best segmentations of all whole texts of docs (doc_id, text).

    rank counts from 0 for the best; equal scores are ranked by the search and come in any order. ids are little-endian
    unsigned 32-bit integers, text is what they decode to. A missing text is empty: one segmentation, without ids. A
    text with fewer segmentations than n_best has all it has. Rows that repeat are segmented each for itself.
    """
    import pyarrow as pa

    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def segment(batches):
        encoder = SentenceEncoder(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                ids_of, texts = (c.to_pylist() for c in batch.slice(lo, 200).columns)
                out = []
                for doc_id, made in zip(ids_of, encoder.encode(texts, n_best)):
                    for rank, (score, ids) in enumerate(made):
                        out.append((doc_id, rank, score, ids, encoder.lattice.decode(ids)))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "rank", "score", "ids", "text"])

    return rows.mapInArrow(segment, "doc_id long, rank int, score double, ids binary, text string")
