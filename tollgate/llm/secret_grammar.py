"""Secret spans: base rules, and formats learned by grammar inference.

The base rules find assignments, access keys and hex runs.  Their matches are
the labelled credentials: all of them grow one
prefix tree per kind, over character shapes (digit, a-f, g-z, A-F, G-Z,
and the marks themselves).  States whose next-symbol and stop frequencies are
statistically compatible (Hoeffding bound, checked through their subtrees) are
merged into a probabilistic automaton.  One more automaton is
learned from all ordinary long tokens.  Spark counts the shapes, the trees' nodes
and, once the states are merged, every symbol of every shape on its way through the
automaton; the driver merges.  A node with less than a ``RESOLUTION``-th of its
kind's weight is no state of its own (what follows it is counted from the first
state on), so the trees that reach the driver stay bounded.  Every other run of credential characters
of at least ``MIN_RUN``, or what base spans leave of one, is a candidate; its
whole length is scored, and it is a secret when some
format explains it better than the ordinary tokens do by ``MIN_GAIN`` nats per
character, generates each of its symbols, and is likely in itself.

Spans are ``(kind, start, end)`` in code points, end exclusive.  Base spans are
matched per kind, leftmost and non-overlapping, and may overlap between kinds;
learned spans (kind ``format``) never overlap a base span.

Defined cases: null and empty texts have no span; a null ``doc_id`` stays null;
repeated rows each give a row; without credentials nothing is learned and
only base spans are found.  A shape weighs as often as it occurs, ``MAX_WEIGHT``
times at most.  Only shapes of credentials leave a task, never the credentials.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.llm.common import arrow_schema, map_batches, materialise, worker_turn

KINDS = ("assign", "access", "hex", "format")
MIN_RUN = 20
#: A node of a kind's prefix tree that has this part of the kind's weight can become a
#: state of its own.
RESOLUTION = 1024
#: A shape that is repeated all over says no more than a few times.
MAX_WEIGHT = 10
#: Depth of the prefix trees (longer runs are counted, and scored, to their ends).
MAX_SHAPE = 96
MARKS = "+/_.=-"
CUT = "~"  # not a symbol of a shape
MIN_GAIN = 0.4
MAX_COST = 2.2  # nats per character under the format: above, it is no known format

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_KEYWORDS = re.compile(r"passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN)
_SHAPES = str.maketrans(
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0" * 10 + "a" * 6 + "g" * 20 + "A" * 6 + "G" * 20
)
#: Symbols a shape can hold, and the stop.
ALPHABET = 5 + len(MARKS) + 1


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base rules' matches."""
    out = []
    if _KEYWORDS.search(text):
        for m in _ASSIGN.finditer(text):
            if len(m.group(1)) >= 12:
                out.append(("assign", m.start(), m.end(), m.group(1)))
    out += [("access", m.start(), m.end(), m.group()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m.group()) for m in _HEX.finditer(text)]
    return out


def candidates(text: str, base: list) -> list[tuple[int, int, str]]:
    """Parts of runs of credential characters that are outside all base spans,
    each of at least ``MIN_RUN``.  One mark that joins a part to a base span belongs
    to neither."""
    out = []
    spans = sorted((s, e) for _, s, e, _ in base)
    i, covered = 0, 0  # spans before i start before this run; they end by covered
    for m in _RUN.finditer(text):
        while i < len(spans) and spans[i][0] <= m.start():
            covered = max(covered, spans[i][1])
            i += 1
        start = m.start()
        if covered > start:
            start = _after_mark(text, covered)
        while i < len(spans) and spans[i][0] < m.end():
            at, end = spans[i]
            if at >= covered:
                out.append((start, at - (text[at - 1] in MARKS)))
            if end > covered:
                covered = end
                start = _after_mark(text, covered)
            i += 1
        out.append((start, m.end()))
    return [(s, e, text[s:e]) for s, e in out if e - s >= MIN_RUN]


def _after_mark(text: str, at: int) -> int:
    return at + (text[at : at + 1] in MARKS and at < len(text))


def shape(value: str) -> str:
    return value.translate(_SHAPES)


def training_shape(value: str) -> str:
    """The shape, or the first ``MAX_SHAPE`` symbols of a longer one and ``CUT``."""
    return shape(value) if len(value) <= MAX_SHAPE else shape(value[:MAX_SHAPE]) + CUT


@dataclass
class Automaton:
    """A probabilistic automaton: per state, log probabilities of each symbol
    (with the next state) and of stopping."""

    step: list[dict] = field(default_factory=list)  # symbol -> (next state, log p)
    stop: list[float] = field(default_factory=list)
    rare: list[float] = field(default_factory=list)  # log p of a symbol not seen there

    def generates(self, word: str) -> bool:
        """Whether every symbol was seen in the state that it meets."""
        state = 0
        for symbol in word:
            if symbol not in self.step[state]:
                return False
            state = self.step[state][symbol][0]
        return True

    def log_likelihood(self, word: str) -> float:
        state, total = 0, 0.0
        for symbol in word:
            hit = self.step[state].get(symbol)
            if hit is None:
                total += self.rare[state]
            else:
                state = hit[0]
                total += hit[1]
        return total + self.stop[state]


def _prefix_tree(words: Counter) -> tuple[list[dict], list[int]]:
    """Arcs (symbol -> [child, count]) and end counts per node; 0 is the root."""
    arcs: list[dict] = [{}]
    ends = [0]
    for word, times in sorted(words.items()):
        node = 0
        cut = word.endswith(CUT)  # it goes on: no end is counted
        for symbol in word.removesuffix(CUT):
            arc = arcs[node].get(symbol)
            if arc is None:
                arc = arcs[node][symbol] = [len(arcs), 0]
                arcs.append({})
                ends.append(0)
            arc[1] += times
            node = arc[0]
        if not cut:
            ends[node] += times
    return arcs, ends


def infer(words: Counter, alpha: float = 0.05) -> Automaton:
    """The automaton of ``words``, which are all at hand."""
    return _automaton(*merge(*_prefix_tree(words), alpha))


def merge(arcs: list[dict], ends: list[int], alpha: float = 0.05) -> tuple[list[dict], list[int]]:
    """Merge statistically compatible states of a prefix tree; the states' arcs and ends.

    The most visited frontier state joins the first accepted state that it is
    compatible with, else it is accepted.  A state seen fewer than eight times
    says nothing on its own and joins the most visited accepted one."""
    slack = math.sqrt(0.5 * math.log(2 / alpha))

    def seen(node: int) -> int:
        return ends[node] + sum(a[1] for a in arcs[node].values())

    def compatible(a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            na, nb = seen(a), seen(b)
            if not na or not nb:
                continue
            limit = slack * (na**-0.5 + nb**-0.5)
            if abs(ends[a] / na - ends[b] / nb) > limit:
                return False
            for symbol in arcs[a].keys() | arcs[b].keys():
                x, y = arcs[a].get(symbol), arcs[b].get(symbol)
                if abs((x[1] / na if x else 0) - (y[1] / nb if y else 0)) > limit:
                    return False
                if x and y and x[0] != y[0] and y[0] not in accepted:  # b's side is still a tree: this ends
                    stack.append((x[0], y[0]))
        return True

    def fold(into: int, node: int) -> None:
        stack = [(into, node)]
        while stack:
            into, node = stack.pop()
            ends[into] += ends[node]
            for symbol, (child, count) in arcs[node].items():
                mine = arcs[into].get(symbol)
                if mine is None:
                    arcs[into][symbol] = [child, count]
                else:
                    mine[1] += count
                    stack.append((mine[0], child))

    accepted = {0: 0}  # in order, each with its number
    while True:
        frontier = [(arc[1], state, symbol) for state in accepted for symbol, arc in arcs[state].items() if arc[0] not in accepted]
        if not frontier:
            break
        _, state, symbol = max(frontier, key=lambda x: (x[0], -x[1], x[2]))
        node = arcs[state][symbol][0]
        into = next((a for a in accepted if compatible(a, node)), None)
        if into is None and seen(node) < 8:
            into = max(accepted, key=seen)
        if into is None:
            accepted[node] = len(accepted)
        else:
            arcs[state][symbol][0] = into
            fold(into, node)

    return [{s: [accepted[child], n] for s, (child, n) in sorted(arcs[a].items())} for a in accepted], [ends[a] for a in accepted]


def _automaton(arcs: list[dict], ends: list[int]) -> Automaton:
    """Probabilities of states' arcs (symbol -> [state, count]) and end counts."""
    out = Automaton()
    for mine, end in zip(arcs, ends):
        floor = end + sum(n for _, n in mine.values()) + 0.5 * ALPHABET
        out.step.append({s: (child, math.log((n + 0.5) / floor)) for s, (child, n) in sorted(mine.items())})
        out.stop.append(math.log((end + 0.5) / floor))
        out.rare.append(math.log(0.5 / floor))
    return out


@dataclass
class Grammar:
    formats: dict[str, Automaton]
    ordinary: Automaton | None

    def gain(self, value: str) -> float:
        """Nats per character by which the best format explains the value
        better than ordinary tokens do; minus infinity for no known format."""
        if not self.formats or self.ordinary is None:
            return -math.inf
        word = shape(value)
        best = max((a.log_likelihood(word) for a in self.formats.values() if a.generates(word)), default=-math.inf)
        if -best > MAX_COST * (len(word) + 1):
            return -math.inf
        return (best - self.ordinary.log_likelihood(word)) / (len(word) + 1)


def all_spans(text: str | None, grammar: Grammar, known: dict) -> tuple[list, list]:
    """Base spans and learned ones, each (kind, start, end)."""
    base = base_spans(text or "")
    learned = []
    for start, end, value in candidates(text or "", base):
        if len(value) > MAX_SHAPE:  # the cache holds short shapes only
            gain = grammar.gain(value)
        else:
            word = shape(value)
            gain = known.get(word)
            if gain is None:
                if len(known) > 200_000:
                    known.clear()
                gain = known[word] = grammar.gain(value)
        if gain >= MIN_GAIN:
            learned.append(("format", start, end))
    return [b[:3] for b in base], learned


def joined(spans: list) -> str:
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


def count_nodes(shapes: DataFrame, least: dict[str, int]) -> DataFrame:
    """Arcs and ends of the nodes of each kind's prefix tree that are seen ``least[kind]``
    times or more: (kind, prefix, seen, arcs as a map of symbol to n; the symbol of an end
    is empty).  ``shapes``: kind, head, weight.

    Shapes are sorted over ranges; a task keeps the nodes of one path at a time.
    Nodes on its first and last path may go on in other tasks, so it gives them
    whatever their count; of the others it has all that there is."""
    schema = T.StructType.fromDDL("kind string, prefix string, symbol string, n long")
    target = arrow_schema(schema)

    def nodes(batches):
        import pyarrow as pa

        worker_turn(__name__)
        out: list = []
        path: list = []  # per depth: arcs, ends, times passed, on the first path
        at_kind, at_word, first = None, "", True

        def close(depth: int, last: bool) -> None:
            while len(path) > depth:
                arcs, ends, passed, edge = path.pop()
                if edge or last or ends + sum(arcs.values()) >= least[at_kind]:
                    prefix = at_word[: len(path)]
                    out.extend((at_kind, prefix, symbol, n) for symbol, n in arcs.items())
                    if ends:
                        out.append((at_kind, prefix, "", ends))
                if path:
                    path[-1][0][at_word[len(path) - 1]] = passed
                    path[-1][2] += passed

        def given():
            columns = [pa.array(c, t) for c, t in zip(zip(*out), target.types)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=target)

        for batch in batches:
            for kind, head, weight in zip(*(batch.column(c).to_pylist() for c in ("kind", "head", "weight"))):
                word = head.removesuffix(CUT)
                if kind != at_kind:
                    close(0, False)
                    path.append([{}, 0, 0, first])
                    at_kind, at_word = kind, ""
                same = 0
                while same < min(len(word), len(at_word)) and word[same] == at_word[same]:
                    same += 1
                close(same + 1, False)
                path.extend([{}, 0, 0, first] for _ in word[same:])
                at_word, first = word, False
                path[-1][2] += weight
                if word == head:  # a cut word goes on: no end is counted
                    path[-1][1] += weight
                if len(out) > 20_000:
                    yield given()
        close(0, True)
        if out:
            yield given()

    arcs = (
        shapes.repartitionByRange("kind", "head").sortWithinPartitions("kind", "head").mapInArrow(nodes, schema)
        .groupBy("kind", "prefix", "symbol").agg(F.sum("n").alias("n"))
    )
    floor = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.col("kind")]
    return (
        arcs.groupBy("kind", "prefix")
        .agg(F.sum("n").alias("seen"), F.map_from_entries(F.collect_list(F.struct("symbol", "n"))).alias("arcs"))
        .where(F.col("seen") >= floor)
    )


def tree_of(nodes: dict[str, dict]) -> tuple[list[dict], list[int]]:
    """The tree of counted nodes by prefix, in the form of ``_prefix_tree``; an arc to a node
    that is not among them ends in a leaf."""
    prefixes = sorted({""} | set(nodes) | {p + symbol for p, arcs in nodes.items() for symbol in arcs})
    number = {p: i for i, p in enumerate(prefixes)}
    arcs: list[dict] = [{} for _ in prefixes]
    ends = [0] * len(prefixes)
    for prefix, found in nodes.items():
        for symbol, n in sorted(found.items()):
            if symbol:
                arcs[number[prefix]][symbol] = [number[prefix + symbol], n]
            else:
                ends[number[prefix]] = n
    return arcs, ends


def count_steps(shapes: DataFrame, steps: dict[str, list[dict]]) -> DataFrame:
    """How often each state of each kind's automaton meets a symbol, or stops (an empty one),
    over all shapes to their ends.  ``steps``: per state, symbol -> next state; the
    first state follows any other symbol.  ``shapes``: kind, head, rest, weight."""
    schema = T.StructType.fromDDL("kind string, state int, symbol string, n long")
    target = arrow_schema(schema)
    shared = shapes.sparkSession.sparkContext.broadcast(steps)

    def walk(batches):
        import pyarrow as pa

        worker_turn(__name__)
        met = {kind: [Counter() for _ in step] for kind, step in shared.value.items()}
        for batch in batches:
            for kind, head, rest, weight in zip(*(batch.column(c).to_pylist() for c in ("kind", "head", "rest", "weight"))):
                state, step, counts = 0, shared.value[kind], met[kind]
                for symbol in head.removesuffix(CUT) + rest:
                    counts[state][symbol] += weight
                    state = step[state].get(symbol, 0)
                counts[state][""] += weight
        out = [(k, i, s, n) for k, states in met.items() for i, c in enumerate(states) for s, n in c.items()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), target.types)], schema=target)

    return shapes.mapInArrow(walk, schema).groupBy("kind", "state", "symbol").agg(F.sum("n").alias("n"))


def learn_formats(docs: DataFrame, resolution: int = RESOLUTION) -> Grammar:
    """Automata from the shapes of all the base rules' matches and of all other long
    runs, over all whole texts."""

    def shapes(cols):
        counts: Counter = Counter()
        for text in cols["text"]:
            base = base_spans(text or "")
            found = [(kind, value) for kind, _, _, value in base]
            found += [("ordinary", value) for _, _, value in candidates(text or "", base)]
            counts.update((kind, training_shape(value), shape(value[MAX_SHAPE:])) for kind, value in found)
        kinds, heads, rests = zip(*counts) if counts else ((), (), ())
        return {"kind": kinds, "head": heads, "rest": rests, "n": list(counts.values())}

    found = (
        map_batches(docs.select("text"), shapes, "kind string, head string, rest string, n long")
        .groupBy("kind", "head", "rest")
        .agg(F.least(F.sum("n"), F.lit(MAX_WEIGHT)).alias("weight"))
    )
    found = materialise(found, "credential-shapes")
    total = {r["kind"]: r["weight"] for r in found.groupBy("kind").agg(F.sum("weight").alias("weight")).collect()}
    learned = {}
    if total:
        heads = found.groupBy("kind", "head").agg(F.sum("weight").alias("weight"))
        nodes = materialise(count_nodes(heads, {kind: -(-n // resolution) for kind, n in total.items()}), "shape-nodes")
        steps = {}
        for kind in total:  # one kind's tree at a time in the driver
            mine = nodes.where(F.col("kind") == kind).select("prefix", "arcs").collect()
            states, _ = merge(*tree_of({r["prefix"]: r["arcs"] for r in mine}))
            steps[kind] = [{s: child for s, (child, _) in arcs.items()} for arcs in states]
        counted = {kind: ([{} for _ in step], [0] * len(step)) for kind, step in steps.items()}
        for r in count_steps(found, steps).collect():  # a row per state and symbol
            arcs, ends = counted[r["kind"]]
            if r["symbol"]:
                arcs[r["state"]][r["symbol"]] = [steps[r["kind"]][r["state"]].get(r["symbol"], 0), r["n"]]
            else:
                ends[r["state"]] = r["n"]
        learned = {kind: _automaton(*counts) for kind, counts in counted.items()}
    ordinary = learned.pop("ordinary", None)
    return Grammar(
        {k: learned[k] for k in KINDS if k in learned},
        ordinary or Automaton([{}], [math.log(0.5)], [math.log(0.5 / ALPHABET)]),
    )


def find_secrets(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """Per document: spans of every whole text; narrow."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)  # bounded by the resolution

    def find(cols):
        known: dict = {}
        found = [all_spans(t, shared.value, known) for t in cols["text"]]
        count = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in KINDS[:3]}
        return {
            "doc_id": cols["doc_id"],
            **count,
            "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
            "spans": [joined(base + learned) for base, learned in found],
            "n_format": [len(learned) for _, learned in found],
        }

    return map_batches(
        docs.select("doc_id", "text"), find,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long",
    )


def redact(text: str | None, spans: list) -> str | None:
    """The text with each span replaced by ``[kind]``; overlapping spans
    are replaced together, under the kind that starts first."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, grammar: Grammar, columns: list[str]) -> DataFrame:
    """All documents with every span redacted, and ``n_chars`` to match."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(grammar)
    chosen = docs.select(*columns)

    def run(batches):
        worker_turn(__name__)
        known: dict = {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            new = [redact(t, sum(all_spans(t, shared.value, known), [])) for t in texts]
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            at = batch.schema.get_field_index("n_chars")
            if at >= 0:
                changed = [n if t == u else len(u) for n, t, u in zip(batch.column(at).to_pylist(), texts, new)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(changed, batch.schema.field(at).type))
            yield batch

    return chosen.mapInArrow(run, chosen.schema)
