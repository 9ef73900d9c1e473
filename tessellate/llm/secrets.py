"""Search for secrets: fixed formats, and formats inferred from their examples.

The fixed formats (`base_spans`) are found by expression. Their matches are the
labelled credentials from which, for each kind, a probabilistic automaton is
inferred: the prefix tree of the examples, character by character, whose states are
merged where the frequencies with which they go on and end are statistically
compatible. A prefix or a separator that the examples share stays a chain of states
of its own, and what is random after it becomes a loop. Every other candidate of a
text is then scored by its likelihood under each automaton against that under a
model of ordinary tokens. The least score that is reported is the one that best
separates credentials and ordinary tokens which taught neither model.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import modest_batches, staged, unstage

KINDS = ("assign", "access", "hex", "inferred")
#: Fixed formats, whose spans the contract names.
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Candidates: whole runs of the characters of credentials that hold a digit.
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z+/_.=-]*+[0-9][A-Za-z0-9+/_.=-]*+")
#: The characters of candidates, and how many they are, with the end as one more.
SYMBOLS = len("+/_.=-") + 62 + 1
#: The shortest value of the base formats, and so of a candidate.
SHORTEST = 6
Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by start and then kind. A run of the
    letters of access or hex is taken whole, so asking for the least length in the
    expression finds what dropping shorter matches leaves."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, covered: list[Span], least: int) -> Iterator[tuple[int, int]]:
    """Where the candidates of at least `least` characters begin and end: runs of the
    characters of credentials with a digit in them, and of a run that base spans
    cover in part, the rest. Full stops at the end of a run belong to the sentence."""
    for m in _TOKEN.finditer(text):
        lo, hi = m.span()
        if hi - lo < least:
            continue
        while hi > lo and text[hi - 1] == ".":
            hi -= 1
        at = lo
        for _, s, e in [c for c in covered if c[1] < hi and lo < c[2]] if covered else ():
            if s - at >= least and any(map(str.isdigit, text[at:s])):
                yield at, s
            at = max(at, e)
        if hi - at >= least and (at == lo or any(map(str.isdigit, text[at:hi]))):
            yield at, hi


@dataclass
class Automaton:
    """States with counts: `moves` symbol to (state, count), `ends` and `total`."""

    moves: list[dict[str, tuple[int, int]]]
    ends: list[int]
    total: list[int]

    def log_likelihood(self, token: str) -> float:
        """A step that a state hasn't seen has a small share; after it, a token goes
        on in the same state."""
        state, out = 0, 0.0
        for c in token:
            step = self.moves[state].get(c)
            out += math.log(((step[1] if step else 0) + 0.05) / (self.total[state] + 0.05 * SYMBOLS))
            state = step[0] if step else state
        return out + math.log((self.ends[state] + 0.05) / (self.total[state] + 0.05 * SYMBOLS))


def infer_automaton(examples: list[str], alpha: float = 0.01, least: int = 6) -> Automaton:
    """Merges the states of the prefix tree of the examples. Kept states are those
    that no merge took in; the children of kept states are tried, the most frequent
    first, against all kept ones. Two states are compatible if by Hoeffding's bound at
    level alpha no frequency of ending or going on differs, theirs and those of the
    states that equal steps lead to; counts are those after all merges so far. Among
    compatible states the one takes the child in that makes the child's steps
    likeliest. A state seen fewer than `least` times shows too little to be kept and
    goes where its steps are likeliest."""
    child: list[dict[str, int]] = [{}]
    steps: list[dict[str, int]] = [{}]
    ends, total = [0], [0]
    for example in examples:
        state = 0
        total[0] += 1
        for c in example:
            if c not in child[state]:
                child[state][c] = len(child)
                child.append({})
                steps.append({})
                ends.append(0)
                total.append(0)
            steps[state][c] = steps[state].get(c, 0) + 1
            state = child[state][c]
            total[state] += 1
        ends[state] += 1
    spread = math.sqrt(0.5 * math.log(2 / alpha))

    def differs(x: int, n: int, y: int, m: int) -> bool:
        return abs(x / n - y / m) > spread * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(a: int, b: int) -> bool:
        todo, seen = [(a, b)], set()
        while todo:
            pair = todo.pop()
            a, b = pair
            if pair in seen or a == b or total[a] < least or total[b] < least:
                continue
            seen.add(pair)
            if differs(ends[a], total[a], ends[b], total[b]):
                return False
            for c in steps[a].keys() | steps[b].keys():
                if differs(steps[a].get(c, 0), total[a], steps[b].get(c, 0), total[b]):
                    return False
                if c in child[a] and c in child[b]:
                    todo.append((child[a][c], child[b][c]))
        return True

    def fit(a: int, b: int) -> float:
        """The log likelihood of the steps and ends of b by the shares of a."""
        whole = total[a] + 0.05 * SYMBOLS
        out = ends[b] * math.log((ends[a] + 0.05) / whole)
        return out + sum(n * math.log((steps[a].get(c, 0) + 0.05) / whole) for c, n in steps[b].items())

    def fold(into: int, tree: int) -> None:
        """Adds the counts of a tree to those of a state and of where its steps lead."""
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            total[a] += total[b]
            ends[a] += ends[b]
            for c, n in steps[b].items():
                steps[a][c] = steps[a].get(c, 0) + n
                if c in child[a]:
                    todo.append((child[a][c], child[b][c]))
                else:
                    child[a][c] = child[b][c]

    kept = [0]
    is_kept = {0}
    while True:
        fringe = [(k, c, t) for k in kept for c, t in child[k].items() if t not in is_kept]
        if not fringe:
            break
        source, c, t = min(fringe, key=lambda x: (-total[x[2]], x[0], x[1]))
        able = kept if total[t] < least else [k for k in kept if compatible(k, t)]
        if able:
            # between equals the state that it comes from, so that loops are short
            into = max(able, key=lambda k: (fit(k, t), k == source, -k))
            child[source][c] = into
            fold(into, t)
        else:
            kept.append(t)
            is_kept.add(t)
    number = {k: i for i, k in enumerate(kept)}
    return Automaton([{c: (number[child[k][c]], n) for c, n in sorted(steps[k].items())} for k in kept], [ends[k] for k in kept], [total[k] for k in kept])


@dataclass
class Grammar:
    """For each kind an automaton, the least score and the least length of what it
    reports; and the model of ordinary tokens."""

    automata: dict[str, tuple[Automaton, float, int]]
    ordinary: Automaton

    @property
    def shortest(self) -> int:
        return min((n for _, _, n in self.automata.values()), default=1 << 30)

    def scores(self, token: str) -> dict[str, float]:
        """By kind: log likelihood over that of an ordinary token, per character."""
        plain = self.ordinary.log_likelihood(token)
        return {kind: (own.log_likelihood(token) - plain) / (len(token) + 1) for kind, (own, _, _) in self.automata.items()}

    def inferred(self, token: str) -> bool:
        scores = self.scores(token)
        return any(len(token) >= n and scores[kind] >= least for kind, (_, least, n) in self.automata.items())


def _bigrams(tokens: list[str]) -> Automaton:
    """A model of ordinary tokens whose state is the last character."""
    symbols = sorted({c for t in tokens for c in t})
    number = {c: i + 1 for i, c in enumerate(symbols)}
    moves: list[Counter] = [Counter() for _ in range(len(symbols) + 1)]
    ends = [0] * (len(symbols) + 1)
    for t in tokens:
        state = 0
        for c in t:
            moves[state][c] += 1
            state = number[c]
        ends[state] += 1
    total = [sum(m.values()) + e for m, e in zip(moves, ends, strict=True)]
    return Automaton([{c: (number[c], n) for c, n in m.items()} for m in moves], ends, total)


def best_threshold(credentials: list[float], ordinary: list[float], wrong: float = 10.0) -> float:
    """The score at which the share of credentials at or above it, less `wrong` times
    the share of ordinary tokens there, is largest, moved halfway down to the next
    ordinary token's."""
    good, bad = sorted(credentials), sorted(ordinary)

    def gain(t: float) -> float:
        return (len(good) - bisect_left(good, t)) / len(good) - wrong * (len(bad) - bisect_left(bad, t)) / max(1, len(bad))

    best = max(good, key=lambda t: (gain(t), t))
    below = bisect_left(bad, best)
    return (best + bad[below - 1]) / 2 if below else best


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = set()
        for x in b.column(0):
            text = x.as_py() or ""
            spans = base_spans(text)
            for kind, start, end in spans:
                value = text[start:end]
                rows.add((kind, _ASSIGN.match(value)[2] if kind == "assign" else value))
            rows.update(("ordinary", text[s:e]) for s, e in candidates(text, spans, SHORTEST))
        kinds, values = zip(*sorted(rows), strict=True) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "value"])


def fit_grammar(docs: DataFrame, sample: int = 1000, least: int = 10) -> Grammar:
    """Examples come from all of docs; of each kind's distinct values the `sample`
    with the least hashes are used, three in four to infer the automaton and every
    fourth to set the least score. Ordinary tokens, candidates outside all base spans,
    are drawn likewise, ten times as many; those that score like nearly all credentials
    of a kind count as unlabelled credentials, unless they are over a fifth, and set
    neither model nor score. A kind with fewer than `least` examples infers nothing. An automaton reports nothing shorter than half its shortest example."""
    h = F.xxhash64("value", F.lit(3))
    found = staged(docs.select("text").mapInArrow(_examples, "kind string, value string").distinct().withColumn("h", h))
    # each kind is an ordered limit of its own: a few rows from every task
    rows = []
    for kind in ("assign", "access", "hex", "ordinary"):
        n = sample * 10 if kind == "ordinary" else sample
        rows.append(found.where(F.col("kind") == kind).orderBy("h", "value").limit(n))
    drawn: dict[str, list[str]] = {}
    for r in rows[0].unionAll(rows[1]).unionAll(rows[2]).unionAll(rows[3]).orderBy("kind", "h", "value").collect():
        drawn.setdefault(r["kind"], []).append(r["value"])
    unstage(found)
    plain = drawn.pop("ordinary", [])
    drawn = {kind: own for kind, own in drawn.items() if len(own) >= least}
    automata = {kind: (infer_automaton([x for i, x in enumerate(own) if i % 4]), -math.inf, max(SHORTEST, min(map(len, own)) // 2)) for kind, own in drawn.items()}
    grammar = Grammar(automata, _bigrams([x for i, x in enumerate(plain) if i % 4] or [f"word{i}" for i in range(10)]))
    for _ in range(2):  # once to find credentials among the ordinary tokens, once without them
        scored = [grammar.scores(x) for x in plain]
        like: set[int] = set()
        for kind, own in drawn.items():
            good = sorted(grammar.scores(x)[kind] for x in own[::4])
            high = {i for i, x in enumerate(scored) if x[kind] >= good[len(good) // 20]}
            like |= high if len(high) * 5 <= len(plain) else set()
            automaton, _, short = automata[kind]
            automata[kind] = (automaton, best_threshold(good, [x[kind] for i, x in enumerate(scored) if i % 4 == 0 and i not in like]), short)
        grammar.ordinary = _bigrams([x for i, x in enumerate(plain) if i % 4 and i not in like] or [f"word{i}" for i in range(10)])
    return grammar


def all_spans(text: str, grammar: Grammar) -> list[Span]:
    """The base spans, and every other candidate token that the grammar accepts."""
    spans = base_spans(text)
    found = [("inferred", s, e) for s, e in candidates(text, spans, grammar.shortest) if grammar.inferred(text[s:e])]
    return sorted(spans + found, key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scan(grammar: Grammar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.column(1):
                spans = all_spans(x.as_py() or "", grammar)
                base = [s for s in spans if s[0] != "inferred"]
                n = Counter(s[0] for s in spans)
                rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def scan_secrets(docs: DataFrame, sample: int = 1000) -> DataFrame:
    """A row for each row of docs: doc_id, n_assign, n_access, n_hex, base_sha256 and
    spans. A span is kind:start:end in code points, end exclusive; spans go by start
    and then kind, joined by commas, and base_sha256 is the SHA-256 of the base ones.

    Null text is empty and has no spans. The automata and the least scores are fitted
    on at most `sample` examples of each kind and ten times as many ordinary tokens
    (see fit_grammar); all candidates of all texts are scored. Rows are each scanned, repeated or without doc_id; an empty table gives
    an empty result; other columns, whatever their names, are ignored."""
    modest_batches(docs.sparkSession)
    grammar = fit_grammar(docs, sample)  # a few hundred states, sent with the tasks
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan(grammar), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
