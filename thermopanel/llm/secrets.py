"""Secret scans over a trigram inverted index.

Every rule is a regular expression. ``trigram_query`` derives from its parse tree which trigrams a text must hold
to match at all, as a Boolean query: AND of ORs of ANDs. Each slice of texts gets an inverted index (trigram to
texts) of the trigrams that the rules ask for; the queries intersect and unite its postings, and only the texts
that remain are verified with the expression. A rule whose tree has no mandatory trigram scans every text.
The index folds the case of ASCII letters, so that one index serves both kinds of rules.

Spans are code points, end exclusive, leftmost and non-overlapping within a kind. A private key runs from its BEGIN line
to its END line, however long; one without an END line before the next BEGIN to the last of the base64 lines after it.

Defined cases: a null text counts as empty and has no spans; empty texts give an empty list and the digest of
the empty text; repeated rows are scanned one by one; no texts give no rows; other columns are ignored, and kept
by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from thermopanel.llm.common import SLICE_ROWS, Texts, per_text, released, slices

parser = re._parser
#: Alternatives a character class or a repeat may stand for before it counts as unknown.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0      # code points that the measured group must have
    group: int = 0
    base: bool = False
    body: bool = False  # a match begins a key, see ``key_spans``


#: The three fixed kinds come first; the others are added by the method.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20, 0, True),
    Rule("hex", r"[0-9a-f]+", 24, 0, True),
    Rule("private", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", body=True),
    Rule("forge", r"\b(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web", r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("login", r"[a-z][a-z0-9+.-]{0,20}://[^\s:/@]+:[^\s:/@]+@[^\s/]+"),
    # cloud
    Rule("session", r"\bASIA[A-Z0-9]{16}\b"),
    Rule("maps", r"\bAIza[0-9A-Za-z_-]{35}"),
    Rule("storage", r"\bAccountKey=[A-Za-z0-9+/]{40,}={0,2}"),
    Rule("droplet", r"\bdo[opr]_v1_[0-9a-f]{64}"),
    # code forges, package registries and model hubs
    Rule("forge_fine", r"\bgithub_pat_[0-9A-Za-z_]{22,}"),
    Rule("forge_own", r"\bglpat-[0-9A-Za-z_-]{20,}"),
    Rule("registry", r"\bnpm_[A-Za-z0-9]{36}"),
    Rule("index", r"\bpypi-[A-Za-z0-9_-]{50,}"),
    Rule("hub", r"\bhf_[A-Za-z0-9]{34}"),
    # payment and shops
    Rule("payment", r"\b(?:sk|rk)_(?:live|test)_[0-9A-Za-z]{16,}"),
    Rule("till", r"\bsq0(?:atp|csp)-[0-9A-Za-z_-]{22,}"),
    Rule("shop", r"\bshp(?:at|ca|pa|ss)_[0-9a-fA-F]{32}"),
    # mail and messages
    Rule("mail", r"\bSG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    Rule("mail_list", r"\b[0-9a-f]{32}-us[0-9]{1,2}\b"),
    Rule("mail_key", r"\bkey-[0-9a-f]{32}\b"),
    Rule("hook", r"https://hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    Rule("bot", r"\b[0-9]{8,10}:AA[A-Za-z0-9_-]{33}"),
    # headers and connection strings of web services and databases
    Rule("header", r"""(?i:authorization)["']?\x20*[:=]\x20*["']?(?i:bearer|basic)\x20+[A-Za-z0-9+/_.=~-]{16,}"""),
    Rule("connection", r"(?i:(?:password|pwd))\x20*=\x20*[^;\s\"']{4,};"),
)

#: A query is True (every text), or a frozenset of alternatives; an alternative is a frozenset of trigrams.
Query = bool | frozenset


def _strings(node) -> set[str] | None:
    """All strings that a piece of the tree stands for, if they are few; None if unknown."""
    out = {""}
    for op, arg in node:
        name = str(op)
        if name == "LITERAL":
            found = {chr(arg)}
        elif name == "IN":
            found = set()
            for kind, value in arg:
                if str(kind) == "LITERAL":
                    found.add(chr(value))
                elif str(kind) == "RANGE" and value[1] - value[0] < MOST_STRINGS:
                    found |= {chr(c) for c in range(value[0], value[1] + 1)}
                else:
                    return None
        elif name == "SUBPATTERN":
            found = _strings(arg[3])
        elif name == "BRANCH":
            parts = [_strings(x) for x in arg[1]]
            found = None if None in parts else set().union(*parts)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= 2:
            one = _strings(arg[2])
            found = None if one is None else {a for n in range(arg[0], arg[1] + 1) for a in _powers(one, n)}
        elif name == "AT":
            found = {""}
        else:
            return None
        if found is None or len(found) * len(out) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in found}
    return {x.lower() for x in out}


def _powers(strings: set[str], n: int) -> set[str]:
    out = {""}
    for _ in range(n):
        out = {a + b for a in out for b in strings}
    return out


def _of_strings(strings: set[str]) -> Query:
    parts = set()
    for x in strings:
        grams = frozenset(x[i:i + 3] for i in range(len(x) - 2))
        if not grams or not x.isascii():
            return True
        parts.add(grams)
    return frozenset(parts)


def _both(a: Query, b: Query) -> Query:
    if a is True or b is True:
        return b if a is True else a
    joined = frozenset(x | y for x in a for y in b)
    return joined if len(joined) <= MOST_STRINGS else a


def _query(node) -> Query:
    """What every match of a sequence must hold: stretches of known strings, and what lies between them."""
    found: Query = True
    known = {""}

    def flushed(found: Query, known: set[str]) -> Query:
        return _both(found, _of_strings(known)) if known != {""} else found

    for item in node:
        more = _strings([item])
        if more is not None and len(more) * len(known) <= MOST_STRINGS:
            known = {a + b for a in known for b in more}
            continue
        found, known = flushed(found, known), {""}
        if more is not None:
            known = more
            continue
        op, arg = item
        name = str(op)
        if name == "SUBPATTERN":
            found = _both(found, _query(arg[3]))
        elif name == "BRANCH":
            parts = [_query(x) for x in arg[1]]
            found = found if True in parts else _both(found, frozenset().union(*parts))
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            found = _both(found, _query(arg[2]))
    return flushed(found, known)


@cache
def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of an expression; True if nothing is mandatory."""
    return _query(parser.parse(pattern))


@cache
def compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.ASCII)


class TrigramIndex:
    """Postings of the wanted trigrams over a slice of texts."""

    FOLD = np.arange(256, dtype=np.uint8)
    FOLD[65:91] = FOLD[97:123]

    def __init__(self, texts: Texts, wanted: list[str], table: np.ndarray):
        self.n = len(texts)
        data = self.FOLD[texts.data].astype(np.uint32)
        self.postings = dict.fromkeys(wanted, np.zeros(0, np.int64))
        if len(data) < 3:
            return
        found = table[(data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]]
        at = np.flatnonzero(found)
        owner = np.searchsorted(texts.offsets, at, side="right") - 1
        inside = at + 3 <= texts.offsets[owner + 1]
        which, owner = found[at[inside]], owner[inside]
        order = np.argsort(which, kind="stable")
        cuts = np.searchsorted(which[order], np.arange(1, len(wanted) + 2))
        for k, gram in enumerate(wanted):
            self.postings[gram] = np.unique(owner[order[cuts[k]:cuts[k + 1]]])

    def candidates(self, query: Query) -> np.ndarray:
        """Numbers of the texts that satisfy a query."""
        if query is True:
            return np.arange(self.n)
        parts = []
        for grams in query:
            lists = sorted((self.postings[g] for g in grams), key=len)
            left = lists[0]
            for more in lists[1:]:
                left = left[np.isin(left, more, assume_unique=True)] if len(left) else left
            parts.append(left)
        return np.unique(np.concatenate(parts))


def wanted_trigrams(rules=RULES) -> tuple[list[str], np.ndarray]:
    """The trigrams of all queries, and a table from trigram code to number (from 1)."""
    grams = sorted({g for r in rules if (q := trigram_query(r.pattern)) is not True for part in q for g in part})
    lookup = np.zeros(1 << 24, np.uint16)
    for k, gram in enumerate(grams, 1):
        a, b, c = gram.encode()
        lookup[a << 16 | b << 8 | c] = k
    return grams, lookup


KEY_LINE = r"-----(BEGIN|END) (?:[A-Z]+ )*PRIVATE KEY-----"
#: What a key without an END line holds: headers such as DEK-Info, then lines of base64.
KEY_REST = r"(?:[ \t]*\r?\n[A-Za-z]+(?:-[A-Za-z]+)+:[^\n]*)*(?:\s*[A-Za-z0-9+/]+=*(?=[ \t]*(?:\r?\n|\Z)))*"


def key_spans(text: str) -> list[tuple[int, int]]:
    """Private keys with their bodies, in one pass over their BEGIN and END lines."""
    out = []
    lines = list(compiled(KEY_LINE).finditer(text))
    for line, following in zip(lines, [*lines[1:], None]):
        if line[1] == "BEGIN":
            whole = following is not None and following[1] == "END"
            out.append((line.start(), following.end() if whole else compiled(KEY_REST).match(text, line.end()).end()))
    return out


def spans_of(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping matches; those that are too short are dropped, not tried again."""
    if rule.body:
        return key_spans(text)
    return [
        m.span() for m in compiled(rule.pattern).finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least
    ]


def scan(column: pa.Array, grams: list[str], lookup: np.ndarray, rules=RULES) -> list[list[tuple[int, int, int]]]:
    """Per text, the spans (start, number of the rule, end) in order."""
    texts = Texts(column)
    index = TrigramIndex(texts, grams, lookup)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    strings: dict[int, str] = {}
    for k, rule in enumerate(rules):
        letters = run_letters(rule.pattern)
        hits = _long_runs(texts, letters, rule.least) if letters is not None else index.candidates(trigram_query(rule.pattern))
        for i in hits.tolist():
            if i not in strings:
                strings[i] = texts.column[i].as_py().decode()
            found[i] += [(a, k, b) for a, b in spans_of(strings[i], rule)]
    for x in found:
        x.sort()
    return found


@cache
def run_letters(pattern: str) -> np.ndarray | None:
    """Which bytes an expression that is one repeated ASCII class is made of; None for others."""
    tree = list(parser.parse(pattern))
    if len(tree) != 1 or str(tree[0][0]) != "MAX_REPEAT" or tree[0][1][:2] != (1, parser.MAXREPEAT):
        return None
    letters = compiled(pattern)
    flags = np.array([bool(letters.match(chr(b))) if b < 128 else False for b in range(256)])
    return flags if len(tree[0][1][2]) == 1 and str(tree[0][1][2][0][0]) == "IN" else None


def _long_runs(texts: Texts, letters: np.ndarray, least: int) -> np.ndarray:
    """Full scan for a rule without trigrams: the texts with ``least`` such letters in a row, on the bytes of all."""
    flags = letters[texts.data]
    edges = np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= least
    # a run may go on into the next text; the verification decides
    first = np.searchsorted(texts.offsets, starts[long], side="right") - 1
    last = np.searchsorted(texts.offsets, ends[long] - 1, side="right") - 1
    return np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)] or [np.zeros(0, np.int64)]))


def _joined(spans, rules) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in spans)


FIELDS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_documents(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, counts of the fixed kinds, the digest of their spans, and all spans."""

    def work():
        grams, lookup = wanted_trigrams(rules)
        base = {k for k, r in enumerate(rules) if r.base}
        kinds = {r.kind: k for k, r in enumerate(rules)}

        def step(batch):
            found = scan(batch.column(batch.schema.get_field_index("text")), grams, lookup, rules)
            out = {f"n_{kind}": [sum(k == kinds[kind] for _, k, _ in x) for x in found] for kind in ("assign", "access", "hex")}
            out["base_sha256"] = [hashlib.sha256(_joined([s for s in x if s[1] in base], rules).encode()).hexdigest() for x in found]
            out["spans"] = [_joined(x, rules) for x in found]
            return out

        return step

    return per_text(docs, "doc_id long", FIELDS, work)


def redacted(text: str, spans: list[tuple[int, int, int]], rules=RULES) -> str:
    """The text with each span, overlapping ones as one, replaced by the kind of the first in brackets."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"[{rules[kind].kind}]"]
        at, i = end, i + 1
    return "".join(out) + text[at:]


def redact(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents with every secret replaced; n_chars, if there, follows the new text."""

    def run(batches):
        grams, lookup = wanted_trigrams(rules)
        for batch in slices(batches, SLICE_ROWS):
            at = batch.schema.get_field_index("text")
            column = batch.column(at)
            found = scan(column, grams, lookup, rules)
            if any(found):
                new = [redacted(t, x, rules) if x else t for t, x in zip(column.to_pylist(), found)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(new, column.type))
                if (n := batch.schema.get_field_index("n_chars")) >= 0:
                    old = batch.column(n).to_pylist()
                    sizes = [len(t) if x else c for t, x, c in zip(new, found, old)]
                    batch = batch.set_column(n, batch.schema.field(n), pa.array(sizes, batch.column(n).type))
            yield batch

    return docs.mapInArrow(released(run), docs.schema)
