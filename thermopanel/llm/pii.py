"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs their votes,
and a span classifier learns from the result. Only DataFrame functions: everything runs in the JVM.

1. Regular expressions name candidates of eight kinds. Four kinds have fixed base patterns, whose matches are always
   kept; the wider patterns also find numbers inside longer rows of digits, written-out addresses, account numbers and names.
2. Five labelers vote for, against or not at all on each candidate: its strict form, its check digits or ranges (which can refute it), gazetteers
   (country codes, card issuers, domain ends, given names), cue words before it, and counter-cues around it.
3. The votes are counted per kind and pattern of votes, at most 8 x 3**5 rows. Expectation-maximisation over these counts
   estimates how often each labeler votes for and against true and false spans of a kind, and so how likely a span with
   these votes is true. No labelled data are used.
4. A naive Bayes classifier over hashed features (shape, length, words and characters around, votes) is trained on all
   candidates of its kind with these likelihoods as soft labels: one sum per feature, combined before the shuffle. Its weights
   are one array of 8 x ``FEATURES`` numbers and 8 biases at any input size; a kind's bias is the share of true spans among its
   wider candidates. Candidates that it accepts and that touch no base span join the result.

Places come from splitting the text at the matches: the code points of the pieces and matches, summed up in blocks.
The expressions are written so that no text costs more than time in proportion to its length: a match starts
only where a run of its characters starts, and repeats are possessive.

Defined cases: a null text counts as empty; empty texts have no spans, the empty list and the digest of the empty
text; repeated rows, equal and null ids are rows like any other; a table without candidates has no added spans; no rows give no
rows. ``redact`` keeps all columns, whatever their names; the other functions read doc_id and text only.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from thermopanel.llm.common import staged

#: Hashed features of a kind, code points of context, matches summed up at once, rounds of estimation.
FEATURES, CONTEXT, BLOCK, ROUNDS = 1 << 11, 48, 128, 40

# ---- fixed values: patterns, cue words and gazetteers ---------------------------------------------------------------
#: In each a match starts where the run of its characters starts, or where the previous match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?+[(\[]at[)\]] ?+[A-Za-z0-9-]++(?: ?+(?:\.|[(\[]dot[)\]]) ?+[A-Za-z0-9-]++)++",
    "ip": r"[0-9A-Fa-f](?<![0-9A-Za-z:.][0-9A-Fa-f])[0-9A-Fa-f]{0,3}+(?::[0-9A-Fa-f]{1,4}+){7}+(?![0-9A-Za-z:])",
    "card": r"[0-9](?<![0-9][0-9])(?:[0-9]{3}(?:[ -][0-9]{4}){3}|[0-9]{12,18}+)(?![0-9])",
    "phone": r"(?:\([0-9]{3}\) ?|[0-9](?<![0-9+][0-9])[0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "iban": r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?: ?[0-9A-Z]{4}){2,7}+(?: ?[0-9A-Z]{1,3}+)?+(?![A-Za-z0-9])",
    "national": r"[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "birth": r"[0-9](?<![0-9./-][0-9])(?:[0-9]{3}-[0-9]{2}-[0-9]{2}|[0-9]?[./][0-9]{1,2}[./][0-9]{4})(?![0-9./-]?[0-9])",
    "name": r"[DFHMPS](?<!\p{L}[DFHMPS])(?:(?<=M)(?:rs?|s|me|onsieur|adame)|(?<=D)r|(?<=P)rof|(?<=H)err|(?<=F)rau|(?<=S)(?:eñora?|ra?))"
            r"\.? \p{Lu}[\p{L}'-]++(?: \p{Lu}[\p{L}'-]++){0,2}+",
}
#: Only a text that holds this can hold a match; each looks for something rare first.
NUMBER = "[0-9]"
NEEDS = {
    ("email", True): "@", ("email", False): r"[(\[]at[)\]]", ("ip", True): r"[0-9]\.[0-9]", ("ip", False): ":[0-9A-Fa-f]{1,4}:",
    ("card", True): NUMBER, ("card", False): NUMBER, ("phone", True): r"\+[0-9]", ("phone", False): NUMBER,
    ("iban", False): NUMBER, ("national", False): NUMBER, ("birth", False): NUMBER, ("name", False): "[DFHMPS][a-zñ]{0,7}\\.? ",
}
KINDS = ("email", "ip", "card", "phone", "iban", "national", "birth", "name")
CUES = {
    "email": "mail|email|e-mail|contact|write to|correo|courriel", "ip": "ip|host|server|login from|address|adresse",
    "card": "card|visa|mastercard|amex|credit|karte|tarjeta|carte", "phone": "phone|tel|call|mobile|cell|fax|telefon|teléfono|téléphone",
    "iban": "iban|account|bank|konto|cuenta|compte", "national": "ssn|social security|tax id|national",
    "birth": "born|birth|dob|birthday|geboren|nacid[oa]|née?", "name": "dear|name|named|signed|contact|from|regards|von|de|chez",
}
COUNTER = "version|ver|release|build|order|invoice|isbn|issn|ref|sku|serial|hash|sha|commit|token|example|chapter|page|figure|id"
ENDS = "com|org|net|edu|gov|info|io|biz|de|fr|es|it|nl|at|ch|be|uk|us|ca|eu|pl|se|no|dk|fi|pt|ie|au|nz|jp|cn|in|br|mx|ar|ru"
CALLING = "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|54|55|56|57|60|61|62|63|64|65|66|81|82|84|86|90|91|92|98|3[578][0-9]|42[01]|97[0-9]"
BANKS = "AD|AE|AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IL|IS|IT|LI|LT|LU|LV|MC|MT|NL|NO|PL|PT|RO|SA|SE|SI|SK|SM|TR"
GIVEN = (
    "Alice|Ana|Anna|Anne|Antonio|Carlos|Carmen|Charles|Charlotte|Christian|Claire|Daniel|David|Elena|Elizabeth|Emma|Eva|Francisco|"
    "François|George|Hans|Helen|Henry|Isabel|Jack|James|Jan|Jane|Jean|John|José|Juan|Julia|Karl|Laura|Louis|Lucas|Luis|Manuel|"
    "Maria|Marie|Mark|Martin|Mary|Michael|Miguel|Nicolas|Olivia|Paul|Paula|Pedro|Peter|Pierre|Robert|Sarah|Sofia|Sophie|Thomas|William"
)
# ---- end of fixed values ---------------------------------------------------------------------------------------------


def running(lengths: Column) -> Column:
    """Exclusive running sums of an array. Summed in blocks, as each step of ``aggregate`` copies its array."""

    def sums(part: Column, head: Column) -> Column:
        grown = F.aggregate(part, F.array(head), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))
        return F.slice(grown, 1, F.size(part))

    blocks = F.when(F.size(lengths) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK)
    )).otherwise(F.array().cast("array<array<int>>"))
    heads = sums(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x)), F.lit(0))
    return F.flatten(F.zip_with(blocks, heads, sums))


def matches(df: DataFrame, text: str, wanted: Mapping[str, tuple[str, bool]]) -> DataFrame:
    """Adds for each (column: kind, base) an array of (start, end, value, before, after): all matches, leftmost and
    non-overlapping."""
    own, none = F.col(text), F.array().cast("array<string>")
    pattern = lambda kind, base: (BASE if base else MORE)[kind]
    numbers = f"{text}n"

    def found(kind: str, base: bool) -> Column:
        needs = NEEDS[kind, base]
        may = F.col(numbers) if needs == NUMBER else F.rlike(own, F.lit(needs))
        return F.when(may, F.regexp_extract_all(own, F.lit(pattern(kind, base)), F.lit(0))).otherwise(none)

    # columns of their own for each step, so that none is worked out again where the next one reads it twice
    df = df.withColumn(numbers, F.rlike(own, F.lit(NUMBER)))
    df = df.withColumns({f"{c}v": found(*which) for c, which in wanted.items()}).drop(numbers)
    df = df.withColumns({
        f"{c}p": F.when(F.size(f"{c}v") > 0, F.split(own, pattern(*which), -1)).otherwise(none) for c, which in wanted.items()
    }).drop(text)
    df = df.withColumns({
        f"{c}h": running(F.transform(f"{c}v", lambda_length(f"{c}p"))) for c in wanted
    })
    df = df.withColumns({c: F.transform(f"{c}v", located(c)) for c in wanted})
    return df.drop(*[f"{c}{x}" for c in wanted for x in "vph"])


def lambda_length(pieces: str):
    return lambda x, i: F.length(x) + F.length(F.get(pieces, i))


def located(c: str):
    """A match with its place and the text around it, from columns of values (v), pieces (p) and running sums (h)."""

    def one(x: Column, i: Column) -> Column:
        start = F.get(f"{c}h", i) + F.length(F.get(f"{c}p", i))
        return F.struct(
            start.alias("start"), (start + F.length(x)).alias("end"), x.alias("value"),
            F.substring(F.get(f"{c}p", i), -CONTEXT, CONTEXT).alias("before"),
            F.substring(F.get(f"{c}p", i + 1), 1, CONTEXT).alias("after"),
        )

    return one


# ---- checks of one value ------------------------------------------------------------------------------------------------
def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Every second digit from the right is doubled; the digit sums of all add up to a multiple of ten."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(number)), F.lit(0),
        lambda acc, i: acc + F.get(F.when(i % 2 == 0, F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9])).otherwise(F.lit(list(range(10)))),
                                   F.substring(number, -i, F.lit(1)).cast("int")),
    )
    return total % 10 == 0


def small_parts(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda x: F.coalesce(x.try_cast("int") <= 255, F.lit(False)))


def mod97(value: Column) -> Column:
    """Country and check digits to the end, letters as two digits; the remainder is 1."""
    flat = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(flat, 5, 40), F.substring(flat, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda acc, c: F.when(c == "", acc).when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def base_holds(kind: str, value: Column) -> Column:
    """What a match of the base pattern must also meet."""
    n = F.length(digits(value))
    return {
        "email": F.lit(True), "ip": small_parts(value), "card": luhn(digits(value)), "phone": n.between(10, 15),
    }[kind]


# ---- labelers ------------------------------------------------------------------------------------------------------------
def vote(for_it: Column, against: Column) -> Column:
    """2 for, 0 against, 1 for no vote."""
    return F.when(F.coalesce(against, F.lit(False)), 0).when(F.coalesce(for_it, F.lit(False)), 2).otherwise(1)


def cued(words: str, context: Column) -> Column:
    return F.rlike(context, F.lit(rf"(?iu)\b(?:{words})\b"))


def votes(kind: str, c: Column, base: bool) -> list[Column]:
    """The five labelers on one candidate."""
    value, before, after = c["value"], c["before"], c["after"]
    number, never, always = digits(value), F.lit(False), F.lit(True)
    n = F.length(number)
    form = {
        "email": (F.lit(base), never), "ip": (always, never), "card": (n.between(15, 16), n < 14), "phone": (F.lit(base), n < 10),
        "iban": (F.length(value) >= 15, F.length(value) < 15), "national": (always, never),
        "birth": (F.rlike(value, F.lit("(?:19|20)[0-9]{2}")), never), "name": (F.contains(value, F.lit(" ")), never),
    }[kind]
    valid = {
        "email": (F.length(value) <= 254, F.rlike(value, F.lit(r"\.\.|-\.|\.-|^\."))),
        "ip": (small_parts(value), ~small_parts(value)) if base else (never, never), "card": (luhn(number), ~luhn(number)),
        "phone": (never, F.rlike(number, F.lit("^0+$"))), "iban": (mod97(value), ~mod97(value)),
        "national": (never, F.rlike(value, F.lit("^(?:000|666|9)|-00-|-0000$"))),
        "birth": (never, F.rlike(value, F.lit("(?:^|[./-])(?:00?|3[2-9]|[4-9][0-9])(?:[./-]|$)"))), "name": (never, never),
    }[kind]
    listed = {
        "email": (F.rlike(value, F.lit(rf"(?i)[.)\] ](?:{ENDS})$")), F.rlike(value, F.lit(r"\.[0-9]+$"))),
        "ip": (never, F.rlike(value, F.lit(r"^(?:0|255)\."))), "card": (F.rlike(number, F.lit("^(?:3[4-9]|4|5[0-9]|6[0-9]|2[2-7])")), never),
        "phone": (F.rlike(value, F.lit(rf"^\+(?:{CALLING})(?![0-9])|^\+(?:{CALLING})")) if base else never, never),
        "iban": (F.rlike(value, F.lit(f"^(?:{BANKS})")), ~F.rlike(value, F.lit(f"^(?:{BANKS})"))), "national": (never, never),
        "birth": (never, never), "name": (F.rlike(value, F.lit(rf" (?:{GIVEN})(?: |$)")), never),
    }[kind]
    near = cued(CUES[kind], before), never
    glued = F.rlike(before, F.lit(r"[\p{L}0-9_/=#]$")) | F.rlike(after, F.lit(r"^[\p{L}0-9_/=]"))
    wrong = never, glued | cued(COUNTER, F.substring(before, -24, 24))
    return [vote(*pair) for pair in (form, valid, listed, near, wrong)]


LABELERS, VALIDITY = 5, 1


def mark_of(code, labeler: int):
    return code // 3 ** labeler % 3


def refuted(votes: Column) -> Column:
    """Check digits or ranges speak against the span."""
    return F.floor(votes / 3 ** VALIDITY) % 3 == 0


def features(kind: str, c: Column, marks: Sequence[Column]) -> Column:
    """Hashed places of the classifier's features."""
    value, before, after = c["value"], c["before"], c["after"]
    shape = value
    for pattern, to in (("[0-9]", "9"), (r"\p{Lu}", "A"), (r"\p{Ll}", "a"), ("(.)\\1{3,}", "$1+")):
        shape = F.regexp_replace(shape, pattern, to)
    parts = {
        "shape": F.substring(shape, 1, 24), "size": F.least(F.length(value), F.lit(40)).cast("string"),
        "before": F.lower(F.regexp_extract(before, r"([\p{L}0-9]+)[^\p{L}0-9]*$", 1)),
        "after": F.lower(F.regexp_extract(after, r"^[^\p{L}0-9]*([\p{L}0-9]+)", 1)),
        "left": F.substring(before, -1, 1), "right": F.substring(after, 1, 1),
        **{f"vote{i}": m.cast("string") for i, m in enumerate(marks)},
    }
    first = KINDS.index(kind) * FEATURES
    return F.array(*[F.pmod(F.xxhash64(F.lit(name), x), F.lit(FEATURES)).cast("int") + first for name, x in parts.items()])


def judged(kind: str, base: bool, found: str) -> Column:
    """The matches in column ``found`` that hold, with votes and features in place of their texts."""

    def one(c: Column) -> Column:
        marks = votes(kind, c, base)
        code = sum((m * 3 ** i for i, m in enumerate(marks)), F.lit(0))
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), F.lit(list(KINDS).index(kind)).alias("kind"),
            F.lit(base).alias("base"), code.alias("votes"), features(kind, c, marks).alias("features"),
        )

    return F.transform(F.filter(found, lambda c: base_holds(kind, c["value"])) if base else F.col(found), one)


def of_kind(spans: str, kind: int) -> Column:
    return F.filter(spans, lambda c: c["base"] & (c["kind"] == kind))


def candidates(docs: DataFrame, keep: Sequence[str], spans: str = "candidates") -> DataFrame:
    """``keep`` and an array of (start, end, kind, base, votes, features): the base spans and the other candidates."""
    mark = uuid.uuid4().hex[:8]
    df = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce("text", F.lit("")).alias(f"t{mark}"))
    wanted = {
        f"c{mark}{k}{int(base)}": (kind, base) for k, kind in enumerate(KINDS) for base in (True, False) if kind in BASE or not base
    }
    df = matches(df, f"t{mark}", wanted)
    df = df.withColumns({c: judged(kind, base, c) for c, (kind, base) in wanted.items()})
    joined = df.select(*[F.col(f"`{c}`") for c in keep], F.concat(*wanted).alias(spans))
    sure = F.filter(spans, lambda c: c["base"])
    # a candidate that touches a base span adds nothing
    free = F.filter(spans, lambda c: ~c["base"] & ~F.exists(sure, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return joined.withColumn(spans, F.array_sort(F.concat(sure, free)))


# ---- reliabilities and classifier -------------------------------------------------------------------------------------------
def reliabilities(counts: Mapping[tuple[int, int], int], rounds: int = ROUNDS) -> dict[tuple[int, int], float]:
    """How likely a span is true, by (kind, code of its votes), from how often each code occurs.

    Two classes, votes independent within a class, a labeler that does not vote says nothing; the priors say that labelers
    are right more often than wrong. Spans that their check digits refute are known to be false and anchor that class.
    """
    lean = {True: {0: 0.5, 2: 4.0}, False: {0: 4.0, 2: 0.5}}
    fresh = lambda: {y: [dict(lean[y]) for _ in range(LABELERS)] for y in lean}
    out = {}
    for kind in {k for k, _ in counts}:
        own = {code: n for (k, code), n in counts.items() if k == kind}
        split = {code: [(i, m) for i in range(LABELERS) if (m := mark_of(code, i)) != 1] for code in own}
        share, table, total = 0.5, fresh(), sum(own.values())
        for _ in range(rounds):
            chance = {}
            for code, marks in split.items():
                log = {y: math.log(share if y else 1 - share) + sum(
                    math.log(table[y][i][m] / sum(table[y][i].values())) for i, m in marks) for y in lean}
                chance[code] = 1 / (1 + math.exp(min(700.0, log[False] - log[True]))) if mark_of(code, VALIDITY) else 0.0
            share = (sum(chance[c] * n for c, n in own.items()) + 1) / (total + 2)
            table = fresh()
            for code, n in own.items():
                for i, m in split[code]:
                    table[True][i][m] += chance[code] * n
                    table[False][i][m] += (1 - chance[code]) * n
        out |= {(kind, code): p for code, p in chance.items()}
    return out


def learnt(found: DataFrame, spans: str = "candidates") -> Column:
    """The classifier's weights as one array value: a weight per kind and feature, then a bias per kind."""
    each = found.select(F.inline(spans)).select("kind", "base", "votes", "features")
    counts = {(r["kind"], r["votes"]): r["n"] for r in each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    listed = ", ".join(f"({k}, {code}, {p!r}D)" for (k, code), p in sorted(reliabilities(counts).items()))
    spark = found.sparkSession
    # at most 8 x 3**5 rows
    chances = spark.sql(f"SELECT * FROM VALUES {listed or '(-1, -1, 0D)'} AS t(kind, votes, chance)")
    soft = each.join(F.broadcast(chances), ["kind", "votes"])
    yes, no = F.sum("chance"), F.sum(1 - F.col("chance"))
    added = F.when(~F.col("base"), F.col("chance"))
    kinds = soft.groupBy("kind").agg(
        ((yes + 1) / (F.count("chance") + 2)).alias("share"),
        F.log((F.coalesce(F.sum(added), F.lit(0.0)) + 1) / (F.coalesce(F.sum(1 - added), F.lit(0.0)) + 1)).alias("bias"),
    )
    sums = soft.select("kind", "chance", F.explode("features").alias("place")).groupBy("kind", "place").agg(yes.alias("yes"), no.alias("no"))
    # how far a feature moves the odds of its kind; two spans of the kind's own share stand for what has not been seen
    share = F.col("share")
    moved = F.log((F.col("yes") + 2 * share) / (F.col("no") + 2 * (1 - share))) - F.log(share / (1 - share))
    seen = sums.join(F.broadcast(kinds), "kind").select("place", moved.alias("w"))
    seen = seen.unionByName(kinds.select((F.col("kind") + len(KINDS) * FEATURES).alias("place"), F.col("bias").alias("w")))
    places = spark.range(len(KINDS) * (FEATURES + 1)).select(F.col("id").cast("int").alias("place"))
    dense = places.join(seen, "place", "left").select("place", F.coalesce("w", F.lit(0.0)).alias("w"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "w"))), lambda x: x["w"])).scalar()


def accepted(found: DataFrame, spans: str = "candidates") -> DataFrame:
    """``spans`` cut to the base spans and what the classifier takes."""
    weights = f"w{uuid.uuid4().hex[:8]}"
    df = found.withColumn(weights, learnt(found, spans))

    def score(c: Column) -> Column:
        bias = F.get(weights, c["kind"] + len(KINDS) * FEATURES)
        return F.aggregate(c["features"], bias, lambda acc, i: acc + F.get(weights, i))

    kept = F.filter(spans, lambda c: c["base"] | (~refuted(c["votes"]) & (score(c) > 0)))
    return df.withColumn(spans, F.when(F.size(spans) > 0, kept).otherwise(F.col(spans))).drop(weights)


def kind_name(kind: Column) -> Column:
    return F.get(F.lit(list(KINDS)), kind)


def joined_spans(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"], c["kind"], c["end"])))
    return F.array_join(F.transform(ordered, lambda c: F.concat_ws(":", kind_name(c["kind"]), c["start"], c["end"])), ",")


def scan_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, number of base spans per kind, their digest, and all spans."""
    found = accepted(staged(candidates(docs, ["doc_id"])))
    base = F.filter("candidates", lambda c: c["base"])
    return found.select(
        "doc_id", *[F.size(of_kind("candidates", k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(BASE)],
        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("candidates")).alias("spans"),
    )


def find_spans(docs: DataFrame) -> DataFrame:
    """One row per span: doc_id, kind, start, end, base."""
    spans = accepted(staged(candidates(docs, ["doc_id"]))).select("doc_id", F.inline("candidates"))
    return spans.select("doc_id", kind_name(F.col("kind")).alias("kind"), "start", "end", "base")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with each span's text replaced by its kind in brackets; of overlapping spans, the first counts."""
    spans = f"s{uuid.uuid4().hex[:8]}"
    found = accepted(staged(candidates(docs, docs.columns, spans)), spans)
    apart = F.aggregate(
        F.array_sort(F.transform(spans, lambda c: F.struct(c["start"], c["kind"], c["end"]))),
        F.array().cast("array<struct<start:int,kind:int,end:int>>"),
        lambda acc, c: F.when((F.size(acc) == 0) | (F.try_element_at(acc, F.lit(-1))["end"] <= c["start"]), F.array_append(acc, c)).otherwise(acc),
    )
    df = found.withColumn(spans, apart)
    before = lambda i: F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"])
    pieces = F.transform(spans, lambda c, i: F.concat(
        F.substring("text", before(i) + 1, c["start"] - before(i)), F.lit("["), kind_name(c["kind"]), F.lit("]")))
    tail = F.substring("text", F.element_at(spans, -1)["end"] + 1, F.length("text"))
    text = F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(F.col("text"))
    return df.withColumn("text", text).drop(spans)
