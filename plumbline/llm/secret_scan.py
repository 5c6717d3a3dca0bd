"""Secrets by fixed patterns, and by automata inferred from what the patterns find."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import slices, stored, texts_of

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex")
ADDED = "format"
# What may be a credential: unbroken runs of the characters and the least length of assigned values.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."

# Distinct credentials of each kind that an automaton is inferred from.
LABELLED = 1_000
# Significance of the test that keeps two states apart.
ALPHA = 0.05
# Likelihood of a character that a state has never seen.
UNSEEN = 1e-4
# Mean log-likelihood ratio a character must gain over ordinary text.
MARGIN = 0.25


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, rank of kind, end`` of the base matches, in that order."""
    out = []
    low = text.lower()
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def value_of(text: str, start: int, kind: int, end: int) -> str:
    """The credential in a base match: the assigned value, or all of it."""
    return ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]


def candidates(text: str, taken: list[tuple[int, int, int]]):
    """Start and text of the candidate runs that touch no base match.

    ``taken`` are the base matches by start; runs come in that order as well, so both
    are walked through together. A stop at the end of a run ends a sentence.
    """
    ends, latest, at = [], 0, 0
    for _, _, e in taken:
        latest = max(latest, e)
        ends.append(latest)
    for m in CANDIDATE.finditer(text):
        run = m[0].rstrip(".")
        if len(run) < 8:
            continue
        start, end = m.start(), m.start() + len(run)
        while at < len(taken) and taken[at][0] < end:
            at += 1
        # Of the base matches that begin before the run's end, one reaches into it.
        if not at or ends[at - 1] <= start:
            yield start, run


class Automaton:
    """A probabilistic automaton merged from the prefix tree of some strings.

    States are merged, from the root outwards, when their frequencies of ending and
    of each next character, and those of all states they lead to, differ by less
    than Hoeffding's bound.
    """

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.total: list[int] = [0]
        self.ends: list[int] = [0]
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        for s in strings:
            at = 0
            self.total[0] += 1
            for c in s:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.total)
                    for column, empty in ((self.total, 0), (self.ends, 0), (self.next, {}), (self.count, {})):
                        column.append(empty)
                self.count[at][c] = self.count[at].get(c, 0) + 1
                at = self.next[at][c]
                self.total[at] += 1
            self.ends[at] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()
        self._freeze()

    def _apart(self, x: int, n: int, y: int, m: int) -> bool:
        return abs(x / n - y / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        """Whether ``b``, the root of a tree, behaves as ``a`` does."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.total[a], self.total[b]
            if not n or not m:
                continue
            if self._apart(self.ends[a], n, self.ends[b], m):
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if self._apart(self.count[a].get(c, 0), n, self.count[b].get(c, 0), m):
                    return False
            todo += [(self.next[a][c], t) for c, t in self.next[b].items() if c in self.next[a]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree under ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.total[a] += self.total[b]
            self.ends[a] += self.ends[b]
            for c, t in self.next[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + self.count[b][c]
                if c in self.next[a]:
                    todo.append((self.next[a][c], t))
                else:
                    self.next[a][c] = t

    def _merge(self) -> None:
        settled = [0]
        while True:
            # A fold may hang new states below any settled one, so the edge is looked up anew.
            edge = [(p, c, t) for p in settled for c, t in self.next[p].items() if t not in settled]
            if not edge:
                break
            # The state seen most often is judged first.
            parent, c, state = min(edge, key=lambda e: (-self.total[e[2]], settled.index(e[0]), e[1]))
            for known in settled:
                if self._compatible(known, state):
                    self.next[parent][c] = known
                    self._fold(known, state)
                    break
            else:
                settled.append(state)
        self.settled = settled

    def _freeze(self) -> None:
        """Log-likelihoods of the settled states only."""
        name = {s: i for i, s in enumerate(self.settled)}
        self.steps: list[dict[str, tuple[float, int]]] = []
        self.stops: list[float] = []
        for s in self.settled:
            n = max(1, self.total[s])
            self.steps.append({c: (math.log(max(k / n, UNSEEN)), name[self.next[s][c]]) for c, k in self.count[s].items()})
            self.stops.append(math.log(max(self.ends[s] / n, UNSEEN)))
        del self.total, self.ends, self.next, self.count

    def log_likelihood(self, s: str, least: float = -math.inf) -> float:
        """Of the characters and the end; stops early below ``least``."""
        at, sum_, unseen = 0, 0.0, math.log(UNSEEN)
        for c in s:
            step = self.steps[at].get(c)
            if step is None:
                sum_ += unseen
            else:
                sum_ += step[0]
                at = step[1]
            if sum_ < least:
                return sum_
        return sum_ + self.stops[at]


class Ordinary:
    """Character pairs of all candidates that no base pattern matches."""

    def __init__(self, pairs: dict[str, int]):
        symbols = "^" + ALPHABET
        rows: dict[str, dict[str, int]] = defaultdict(dict)
        for p, n in pairs.items():
            rows[p[0]][p[1]] = n
        k = len(ALPHABET) + 1
        self.log = {
            a + b: math.log((rows[a].get(b, 0) + 0.5) / (sum(rows[a].values()) + 0.5 * k))
            for a in symbols
            for b in ALPHABET + "$"
        }

    def log_likelihood(self, s: str) -> float:
        log = self.log
        return sum(log[a + b] for a, b in zip("^" + s, s + "$"))


def is_format(s: str, automata: list[Automaton], ordinary: Ordinary, margin: float = MARGIN) -> bool:
    least = ordinary.log_likelihood(s) + margin * (len(s) + 1)
    return any(a.log_likelihood(s, least) >= least for a in automata)


def learn(texts: DataFrame, labelled: int = LABELLED) -> tuple[list[Automaton], Ordinary]:
    """Automata of the credentials the base patterns find in ``texts``, and the ordinary model.

    One pass over all whole texts. At most ``labelled`` distinct credentials of a
    kind, in the order of their hashes, are fetched and merged on the driver; pairs
    of characters are counted in all other candidates and summed per task.
    """

    def gather(batches):
        for batch in batches:
            for part in slices(batch):
                found, runs = set(), Counter()
                for t in part.column("text").to_pylist():
                    spans = base_spans(t)
                    found.update((KINDS[k], value_of(t, s, k, e)) for s, k, e in spans)
                    runs.update(w for _, w in candidates(t, spans))
                pairs: Counter = Counter()
                for w, n in runs.items():
                    for p in map("".join, zip("^" + w, w + "$")):
                        pairs[p] += n
                rows = [(k, v, 1) for k, v in found] + [("", p, n) for p, n in pairs.items()]
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], pa.int64())],
                        ["kind", "value", "n"],
                    )

    gathered = texts.select("text").mapInArrow(gather, "kind string, value string, n bigint")
    summed = stored(gathered.groupBy("kind", "value").agg(F.sum("n").alias("n")), "secret-formats")
    automata = []
    for kind in KINDS:
        rows = summed.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(labelled).collect()
        if rows:
            automata.append(Automaton([r["value"] for r in rows]))
    return automata, Ordinary({r["value"]: r["n"] for r in summed.where("kind = ''").collect()})


SPANS = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def joined(spans: list[tuple[int, int, int]]) -> str:
    names = (*KINDS, ADDED)
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> DataFrame:
    """Per row of ``docs``: counts of base matches, their digest, and all spans.

    A span is ``kind:start:end`` in code points, the end exclusive. Base spans stand
    as found. Every other unbroken run of 8 or more credential characters, which are
    those of assigned values, is scored whole, stops at its end aside: it is a span of kind ``format`` if an automaton inferred from the base
    credentials makes it likelier, by ``MARGIN`` a character, than ordinary runs are.
    Without base credentials in the corpus there are no automata and no such spans.

    Null and empty texts have no spans (the digest is that of the empty string).
    Rows that share an id are scanned apart.
    """
    texts = texts_of(docs, id_col, text_col)
    automata, ordinary = learn(texts, labelled)

    def scan(batches):
        known: dict[str, bool] = {}
        for batch in batches:
            for part in slices(batch):
                out = []
                for k, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    base = base_spans(t)
                    spans = list(base)
                    if automata:
                        for start, w in candidates(t, base):
                            verdict = known.get(w)
                            if verdict is None:
                                verdict = is_format(w, automata, ordinary)
                                if len(known) < 200_000 and len(w) <= 64:
                                    known[w] = verdict
                            if verdict:
                                spans.append((start, len(KINDS), start + len(w)))
                    n = Counter(kind for _, kind, _ in base)
                    digest = hashlib.sha256(joined(base).encode()).hexdigest()
                    out.append((k, n[0], n[1], n[2], digest, joined(spans)))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2
                names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return texts.mapInArrow(scan, SPANS)
