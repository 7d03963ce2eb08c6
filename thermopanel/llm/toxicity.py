"""Toxicity: Levenshtein automata over a lexicon trie, scored in context windows.

The lexicon is learned from the labelled training rows: words, and stems (beginnings of words), that stand in
far more toxic than other documents, each distinct text counted once. A term is taken if its counts are beyond chance
for so many terms, at whatever rate it stands in the toxic rows. Its terms form a trie. The Levenshtein automaton runs over the trie:
its states are sets of (trie node, edits so far), and a word is left as soon as no state remains, so misspelled
terms are found in one walk, without comparing with each term. A stem matches at the start of a longer word.

A hit weighs its term's learned log-odds times a factor for the distance; hits within ``WINDOW`` words of each
other add up, and a hit in a quotation (quote marks around it, or a word of reporting just before) counts
``QUOTED`` of its weight. The strongest window and the sums of exact and misspelled hits are the features of a
logistic model, fitted on about ``FIT_ROWS`` distinct labelled texts, chosen by their hash, or on all if there are fewer.

Defined cases: a null or empty text has no hits and gets the score of a text without hits; without both kinds of
labels every score is 0; repeated rows are scored one by one; no rows give no rows; other columns
(lang and source among them) are never read, and are kept by ``filter_documents``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from thermopanel.llm.common import Texts, keep_rows, per_text, released, remainder, rows, slices, staged

#: Labelled texts that the logistic model is fitted on, on average, if there are more; the lexicon counts all.
FIT_ROWS = 20_000
#: Labelled rows whose ids and labels travel as one array; beyond it, documents are joined with the labels.
LABEL_LIMIT = 2_000_000
STEM_LENGTHS = (4, 5, 6)
LEAST_ODDS = 3.0
#: Terms that chance may add to the lexicon, at most, on average.
CHANCE = 1.0
WINDOW = 12
QUOTED = 0.3
THRESHOLD = 0.7
#: Lower-case letters, and signs that stand for letters within a word.
WORD = re.compile(r"[^\W_]+(?:[@$!*'’_-]+[^\W_]+)*")
REPORTING = frozenset("said says wrote quoted quote called quoting dit disait sagte schrieb dijo decía".split())
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, "'": None, "’": None, "-": None, "_": None})
#: Terms shorter than this are matched exactly; from LONG on, two edits are allowed.
SHORT, LONG = 4, 8
BY_DISTANCE = (1.0, 0.8, 0.6)
#: Most edits of any term, and words set against the lexicon at once.
MOST_EDITS, NEAR_WORDS = 2, 16_384
#: Words whose match a worker remembers, states of the automaton that it keeps, and terms that a task counts before it
#: passes them on; these bound its memory.
REMEMBERED, STATES, COUNTED = 200_000, 20_000, 300_000


def allowed(term: str) -> int:
    """Edits that still count as the term."""
    return 0 if len(term) <= SHORT else 1 if len(term) < LONG else 2


class Node:
    """A trie node; ``most`` is the largest number of edits that a term below allows."""

    __slots__ = ("next", "term", "most")

    def __init__(self):
        self.next: dict[str, Node] = {}
        self.term: str | None = None
        self.most = 0


class Lexicon:
    """Words found with misspellings, stems found at the beginnings of words; both with weights.

    A configuration is (trie node, edits so far, letter still due after a swap). Reading a letter keeps,
    replaces, inserts, leaves out or swaps; the set of configurations is a state of the intersection of trie and
    Levenshtein automaton, made deterministic as words call for it. Letters that no term has are one letter.
    """

    def __init__(self, weights: dict[str, float], stems: dict[str, float]):
        self.weights, self.stems = weights, stems
        self.root = Node()
        for term in weights:
            node = self.root
            for letter in term:
                node.most = max(node.most, allowed(term))
                node = node.next.setdefault(letter, Node())
            node.term, node.most = term, max(node.most, allowed(term))
        self.letters = {c for t in weights for c in t}
        self.known: dict[str, tuple[float, int]] = {}  # outlives the states
        self.reset()

    def reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.sets: list[frozenset] = []
        self.accepts: list[tuple[float, int]] = []
        self.start = self._state({(self.root, 0, "")})

    def __getstate__(self):
        return {"weights": self.weights, "stems": self.stems}

    def __setstate__(self, state):
        self.__init__(state["weights"], state["stems"])

    def _state(self, found: set) -> int:
        todo = list(found)
        while todo:  # terms may lack a letter that the word leaves out
            node, edits, due = todo.pop()
            if not due and edits < node.most:
                for child in node.next.values():
                    more = (child, edits + 1, "")
                    if child.most > edits and more not in found:
                        found.add(more)
                        todo.append(more)
        key = frozenset(found)
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ends = [(self.weights[n.term] * BY_DISTANCE[e], -e) for n, e, due in key if n.term and not due and e <= allowed(n.term)]
            weight, edits = max(ends, default=(0.0, 0))
            self.accepts.append((weight, -edits))
        return number

    def _step(self, state: int, letter: str) -> int:
        found = set()
        for node, edits, due in self.sets[state]:
            if due:
                if due == letter:
                    found.add((node, edits, ""))
                continue
            child = node.next.get(letter)
            if child is not None and child.most >= edits:
                found.add((child, edits, ""))
            if edits < node.most:
                found.add((node, edits + 1, ""))
                for other, child in node.next.items():
                    if child.most > edits:
                        if other != letter:
                            found.add((child, edits + 1, ""))
                            swapped = child.next.get(letter)
                            if swapped is not None and swapped.most > edits:
                                found.add((swapped, edits + 1, other))
        return self._state(found) if found else -1

    def near(self, words: list[str]) -> np.ndarray:
        """Which words can match a term at all; only these need the automaton.

        A pair of word and term is ruled out by lengths, by letters (an edit adds or takes at most one), and then by
        the edit distance with swaps of neighbours, worked out for many pairs at once within a band around the diagonal.
        """
        out = np.zeros(len(words), bool)
        terms = list(self.weights)
        if not terms or not words:
            return out
        sizes, masks, letters = _as_arrays(words, max(map(len, terms)) + MOST_EDITS)
        t_sizes, t_masks, t_letters = _as_arrays(terms, max(map(len, terms)))
        edits = np.array([allowed(t) for t in terms])
        for first in range(0, len(words), NEAR_WORDS):
            part = slice(first, first + NEAR_WORDS)
            size, mask, pairs = sizes[part], masks[part], []
            for t in range(len(terms)):
                fit = np.flatnonzero(np.abs(size - t_sizes[t]) <= edits[t])
                fit = fit[(np.bitwise_count(mask[fit] & ~t_masks[t]) <= edits[t]) & (np.bitwise_count(t_masks[t] & ~mask[fit]) <= edits[t])]
                pairs.append(np.column_stack([fit, np.full(len(fit), t)]))
            w, t = np.concatenate(pairs).T
            hit = _distances(letters[part][w], size[w], t_letters[t], t_sizes[t]) <= edits[t]
            out[first + w[hit]] = True
        return out

    def meet(self, words: Iterable[str]) -> None:
        """Remember at once all new words that no term can match; the others go through the automaton when asked for."""
        new = [w for w in set(words) if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        plain = [w if w.isalpha() else w.translate(LOOKALIKE) for w in new]
        stem = np.array([any(x[:n] in self.stems for x in (w, p) for n in STEM_LENGTHS) for w, p in zip(new, plain)], bool)
        far = ~(self.near(new) | self.near(plain) | stem)
        self.known.update((new[i], (0.0, 0)) for i in np.flatnonzero(far).tolist())

    def match(self, word: str) -> tuple[float, int]:
        """Weight and edits of the best whole term; (0, 0) without one."""
        state = self.start
        for letter in word:
            if letter not in self.letters:
                letter = ""
            step = self.steps[state].get(letter)
            if step is None:
                step = self.steps[state][letter] = self._step(state, letter)
            if step < 0:
                return 0.0, 0
            state = step
        return self.accepts[state]

    def weight(self, word: str) -> tuple[float, int]:
        """Of the best match of a word, look-alike signs read as letters too."""
        found = self.known.get(word)
        if found is None:
            if len(self.sets) >= STATES:
                self.reset()
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = max(self.match(word), (max((self.stems.get(word[:n], 0.0) for n in STEM_LENGTHS), default=0.0), 0))
            if not word.isalpha():
                plain = word.translate(LOOKALIKE)
                weight, edits = max(self.match(plain), (max((self.stems.get(plain[:n], 0.0) for n in STEM_LENGTHS), default=0.0), 0))
                found = max(found, (weight * BY_DISTANCE[1], max(edits, 1)) if weight else (0.0, 0))
            self.known[word] = found
        return found


def _as_arrays(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, sets of letters as bits, and letters in ``width`` columns; longer words are cut, their length says so."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    cut = "".join([w[:width].ljust(width, "\0") for w in words])
    letters = np.frombuffer(cut.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), width)
    bits = np.where(letters > 0, np.uint64(1) << (letters % 64).astype(np.uint64), np.uint64(0))
    return sizes, np.bitwise_or.reduce(bits, axis=1), letters


def _distances(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """Edits (one letter more, less, other, or two swapped) between rows, right up to ``MOST_EDITS``, larger beyond."""
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    n, far = a.shape[1], np.uint8(MOST_EDITS + 1)
    out = np.where(a_sizes == 0, np.minimum(b_sizes, far), far).astype(np.uint8)
    rows_: list[dict[int, np.ndarray]] = [{}, {j: np.full(n, j, np.uint8) for j in range(min(MOST_EDITS, len(b)) + 1)}]
    none = np.full(n, far)
    for i in range(1, len(a) + 1):
        row: dict[int, np.ndarray] = {}
        for j in range(max(0, i - MOST_EDITS), min(len(b), i + MOST_EDITS) + 1):
            if not j:
                row[0] = np.full(n, min(i, far), np.uint8)
                continue
            best = rows_[1].get(j - 1, none) + (a[i - 1] != b[j - 1])
            best = np.minimum(best, np.minimum(rows_[1].get(j, none), row.get(j - 1, none)) + np.uint8(1))
            if i > 1 and j > 1 and j - 2 in rows_[0]:
                swapped = (a[i - 1] == b[j - 2]) & (a[i - 2] == b[j - 1])
                best = np.where(swapped, np.minimum(best, rows_[0][j - 2] + np.uint8(1)), best)
            row[j] = np.minimum(best, far)
        ends = a_sizes == i
        for j, value in row.items():
            here = ends & (b_sizes == j)
            out[here] = value[here]
        rows_ = [rows_[1], row]
    return out


FEATURES = 4


def features(text: str, lexicon: Lexicon) -> list[float]:
    """Strongest window, logarithms of the sums of exact and of misspelled hits, number of hits (up to 5)."""
    hits: list[tuple[int, float, int]] = []
    n, previous = 0, ""
    quotes: Quotes | None = None
    text = text.lower()  # some letters get longer, so that all places are those of this text
    for m in WORD.finditer(text):
        weight, edits = lexicon.weight(m.group())
        if weight > 0:
            if quotes is None:
                quotes = Quotes(text)
            hits.append((n, weight * (QUOTED if previous in REPORTING or quotes.hold(m.start(), m.end()) else 1.0), edits))
        previous = m.group()
        n += 1
    if not hits:
        return [0.0] * FEATURES
    strongest, first, total = 0.0, 0, 0.0
    for at, weight, _ in hits:
        total += weight
        while hits[first][0] < at - WINDOW:
            total -= hits[first][1]
            first += 1
        strongest = max(strongest, total)
    exact, bent = sum(w for _, w, e in hits if not e), sum(w for _, w, e in hits if e)
    return [min(strongest, 20.0) / 5, float(np.log1p(exact)), float(np.log1p(bent)), min(sum(w for _, w, _ in hits), 40.0) / 10]


def all_features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Features of every text; only texts with a hit among their distinct words are read word by word."""
    texts = Texts(column)
    _, first, inverse = np.unique(texts.hashes(), return_index=True, return_inverse=True)
    data = texts.data.tobytes()
    spans = zip(texts.starts[first].tolist(), texts.ends[first].tolist())
    found = [WORD.findall(data[a:b].decode().lower()) for a, b in spans]
    lexicon.meet(chain.from_iterable(found))
    hit = np.array([any(lexicon.weight(w)[0] > 0 for w in x) for x in found], bool)
    out = np.zeros((len(texts), FEATURES))
    if len(hit):
        for i in np.unique(texts.owners[hit[inverse]]).tolist():
            out[i] = features(texts.column[i].as_py().decode(), lexicon)
    return out


class Quotes:
    """Places of quote marks and line ends of a text, in order."""

    def __init__(self, text: str):
        self.marks = [m.start() for m in re.finditer("[\"“”„«»]", text)]
        self.lines = [m.start() for m in re.finditer("\n", text)] if self.marks else []

    def hold(self, start: int, end: int) -> bool:
        """An odd number of quote marks before on its line, and one after it on the line."""
        if not self.marks:
            return False
        line = bisect_left(self.lines, start)
        line_start = self.lines[line - 1] + 1 if line else 0
        line_end = self.lines[line] if line < len(self.lines) else math.inf
        here, after = bisect_left(self.marks, start), bisect_left(self.marks, end)
        return (here - bisect_left(self.marks, line_start)) % 2 == 1 and after < len(self.marks) and self.marks[after] < line_end


def _terms(text: str) -> tuple[set[str], set[str]]:
    words = {m.group() for m in WORD.finditer(text.lower())}
    return words, {w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n}


@dataclass
class Labels:
    """Ids and labels of the training rows, sorted by id."""

    ids: np.ndarray
    toxic: np.ndarray

    def of(self, column: pa.Array) -> np.ndarray:
        """1, 0, or -1 for rows that are not to be learned from."""
        values = np.array([-1 if v is None else v for v in column.to_pylist()], np.int64)
        if not len(self.ids):
            return np.full(len(values), -1)
        at = np.minimum(np.searchsorted(self.ids, values), len(self.ids) - 1)
        return np.where((self.ids[at] == values) & np.array([v is not None for v in column.to_pylist()], bool), self.toxic[at], -1)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """toxic, text of the labelled rows with crc32(doc_id) mod 3 other than 1; a join only for many labels."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    few = known.limit(LABEL_LIMIT + 1).toArrow().to_pandas().sort_values("doc_id")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if len(few) > LABEL_LIMIT:
        return docs.join(known, "doc_id").select("toxic", "text")
    table = docs.sparkSession.sparkContext.broadcast(Labels(few["doc_id"].to_numpy(np.int64), few["toxic"].to_numpy(np.int64)))
    schema = "toxic int, text string"

    def pick(batches):
        for batch in slices(batches):
            toxic = table.value.of(batch.column(0))
            chosen = batch.filter(pa.array(toxic >= 0))
            yield rows(schema, toxic[toxic >= 0], chosen.column(1).cast(pa.string()))

    return docs.mapInArrow(released(pick), schema)


def learn_lexicon(train: DataFrame) -> tuple[Lexicon, tuple[int, int]]:
    """Terms by their log-odds, from document counts over all training rows; a text counts once for a label.

    If a term that stands in ``k`` texts has nothing to do with toxicity, the chance that a share ``s`` of them or more
    is toxic, where the share of all is ``p``, is at most exp(-k * KL(s || p)). With ``tested`` terms, those are taken for
    which it is at most ``CHANCE`` / ``tested``. Counts and test stay distributed; only the terms taken are collected.
    """
    n = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_other:
        return Lexicon({}, {}), (n_toxic, n_other)
    counted = staged(_counted(train).where("toxic > 0"))
    tested = counted.count()
    toxic, other = F.col("toxic"), F.col("other")
    p, of_term = n_toxic / (n_toxic + n_other), toxic + other
    divergence = toxic * F.ln(toxic / (of_term * p)) + F.when(other > 0, other * F.ln(other / (of_term * (1 - p)))).otherwise(0.0)
    log_odds = F.ln((toxic + 0.5) / (n_toxic + 1)) - F.ln((other + 0.5) / (n_other + 1))
    taken = counted.where((log_odds > LEAST_ODDS) & (toxic > of_term * p) & (divergence >= float(np.log(max(tested, 1) / CHANCE)))).select(
        "term", "stem", "toxic", log_odds.alias("odds")).collect()
    found = {(r["term"], r["stem"]): r["toxic"] for r in taken}
    odds = {(r["term"], r["stem"]): r["odds"] for r in taken}
    best = sorted(found, key=lambda k: (-odds[k] * found[k], -len(k[0]), k))
    words, stems, begun = {k[0] for k in best if not k[1]}, {}, set()
    commonest: dict[str, int] = {}  # count of the commonest word that begins so
    for w in words:
        for size in STEM_LENGTHS:
            commonest[w[:size]] = max(commonest.get(w[:size], 0), found[w, False])
    for term, stem in best:
        # a stem is kept if it says more than each word and longer stem that begins with it
        if stem and term not in begun and not any(term[:size] in stems for size in STEM_LENGTHS) and found[term, True] > 1.2 * commonest.get(term, 0):
            stems[term] = odds[term, True]
            begun.update(term[:size] for size in STEM_LENGTHS)
    return Lexicon({w: odds[w, False] for w in words if not any(w[:size] in stems for size in STEM_LENGTHS)}, stems), (n_toxic, n_other)


def _counted(train: DataFrame) -> DataFrame:
    """term, stem, toxic, other: in how many texts of either label each word and stem stands."""
    schema = "term string, stem boolean, toxic long, other long"

    def count(batches):
        found: tuple[Counter, Counter] = Counter(), Counter()  # not toxic, toxic

        def flush():
            for label, counts in enumerate(found):
                none = [0] * len(counts)
                some = list(counts.values())
                yield rows(schema, [k[0] for k in counts], [k[1] for k in counts], *((some, none) if label else (none, some)))
                counts.clear()

        for batch in slices(batches):
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, stems = _terms(text or "")
                found[toxic == 1].update((w, False) for w in words)
                found[toxic == 1].update((w, True) for w in stems)
                if len(found[0]) + len(found[1]) > COUNTED:
                    yield from flush()
        yield from flush()

    return train.where("toxic IN (0, 1)").select("toxic", "text").mapInArrow(released(count), schema).groupBy("term", "stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[Lexicon, np.ndarray | None]:
    """Lexicon and weights of the logistic model (None without both labels)."""
    train = staged(training_rows(docs, labels).select("toxic", F.coalesce("text", F.lit("")).alias("text")).distinct())
    lexicon, (n_toxic, n_other) = learn_lexicon(train)
    if not n_toxic or not n_other:
        return lexicon, None
    shared = train.sparkSession.sparkContext.broadcast(lexicon)
    names = [f"x{i}" for i in range(FEATURES)]
    schema = "toxic int, " + ", ".join(f"{x} double" for x in names)

    def measure(batches):
        for batch in slices(batches):
            yield rows(schema, batch.column(0), *all_features(batch.column(1), shared.value).T)

    # a share of the texts by their hash: no sort, and the same texts in any order of the input
    share = min(1.0, fit_rows / (n_toxic + n_other))
    sample = train.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    table = sample.mapInArrow(released(measure), schema).toArrow().to_pandas()
    return lexicon, logistic(table[names].to_numpy(), table["toxic"].to_numpy(float))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Penalised Newton steps; both labels weigh the same in total."""
    x = np.column_stack([x, np.ones(len(x))])
    if not len(x) or y.min() == y.max():
        return np.zeros(x.shape[1])
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (share * (y - p)) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return np.round(w, 9)


def scores(column: pa.Array, lexicon: Lexicon, weights: np.ndarray | None) -> np.ndarray:
    if weights is None:
        return np.zeros(len(column))
    return 1 / (1 + np.exp(-np.clip(all_features(column, lexicon) @ weights[:-1] + weights[-1], -30, 30)))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    lexicon, weights = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, weights))

    def work():
        model = shared.value

        def step(batch):
            found = scores(batch.column(1), *model)
            return {
                "held_out": [remainder(i, 3) == 1 for i in batch.column(0).to_pylist()],
                "score": found,
                "predicted": (found >= THRESHOLD).astype(np.int32),
            }

        return step

    return per_text(docs, "doc_id long", "held_out boolean, score double, predicted int", work)


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    lexicon, weights = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, weights))

    def work():
        model = shared.value
        return lambda batch: scores(batch.column(batch.schema.get_field_index("text")), *model) < THRESHOLD

    return keep_rows(docs, work)
