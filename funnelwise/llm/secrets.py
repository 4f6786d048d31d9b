"""Secret scans over a trigram index: regexes become Boolean trigram queries, their candidates are verified.

Only DataFrame functions run on the executors. A posting says that a document's text, in lower case,
holds a trigram; postings are made for the trigrams that the rules' queries name. Each rule's postings are
intersected, the candidates joined to their texts, and the regexes run there; a bitmap of the candidates' keys picks
the texts to shuffle for that. A rule without a mandatory trigram is run on every text, where it lies.
"""

from __future__ import annotations

from re import _constants as node, _parser as parser  # the standard library has no public module that parses regexes
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import keep
from .keysets import split_by_keys

#: Between two fragments of a text that a regex does not fix.
_GAP = None
_MOST_PATHS = 64
_NO_SPANS = "array<struct<start:int,kind_no:int,kind:string,end:int>>"


@dataclass(frozen=True)
class SecretRule:
    """A regex, leftmost and non-overlapping; matches whose `group` is shorter than `at_least` are dropped.

    With `closes`, a match opens a block that runs to the next match of that regex, with no five dashes and no other opening between;
    an open one runs over the header fields and base64 words that follow, however many they are (see armor_length).
    """

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1
    closes: str | None = None


BASE_RULES = [
    SecretRule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]+", 0, 24),
]
_KEY_NAME = r"[A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
MORE_RULES = [
    SecretRule("private_key", f"-----BEGIN {_KEY_NAME}", closes=f"-----END {_KEY_NAME}"),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("google", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
]
RULES = BASE_RULES + MORE_RULES


def _paths(tokens) -> list[list[str | None]]:
    """The ways through a parsed regex, each a list of fixed fragments and gaps."""
    ways: list[list[str | None]] = [[]]
    for op, arg in tokens:
        if op is node.LITERAL:
            step = [[chr(arg)]]
        elif op is node.SUBPATTERN:
            step = _paths(arg[3])
        elif op is node.BRANCH:
            step = [way for branch in arg[1] for way in _paths(branch)]
        elif op is node.IN and len(arg) <= 8 and all(kind is node.LITERAL for kind, _ in arg):
            step = [[chr(value)] for _, value in arg]
        elif op in (node.MAX_REPEAT, node.MIN_REPEAT):
            least, most, inner = arg
            once = _paths(inner)
            if (least, most) == (0, 1):
                step = [[], *once]
            elif least == 0:
                step = [[_GAP]]
            else:
                step = [way + [_GAP] + way if least > 1 else way + [_GAP] for way in once]
        elif op is node.AT:
            step = [[]]
        else:
            step = [[_GAP]]
        if len(step) * len(ways) > _MOST_PATHS:
            step = [[_GAP]]
        ways = [way + more for way in ways for more in step]
    return ways


def trigram_query(pattern: str) -> list[set[str]] | None:
    """Sets of lower-case trigrams; every match holds all of one set. None: no trigram is mandatory."""
    query: list[set[str]] = []
    for way in _paths(parser.parse(pattern)):
        fixed = "".join("\0" if part is _GAP else part.lower() for part in way).split("\0")
        grams = {run[i : i + 3] for run in fixed for i in range(len(run) - 2)}
        if not grams:
            return None
        if not any(other <= grams for other in query):
            query = [other for other in query if not grams < other] + [grams]
    return query


def build_postings(docs: DataFrame, trigrams: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """(trigram, key): the inverted index of the texts, for the trigrams asked for. One map pass."""
    held = F.transform(
        F.array(F.lower(F.col(text))),
        lambda low: F.filter(F.array(*map(F.lit, trigrams)) if trigrams else F.array().cast("array<string>"), lambda gram: F.contains(low, gram)),
    )[0]
    return docs.select(F.col(key), F.explode(held).alias("trigram"))


def candidates(postings: DataFrame, queries: list[list[set[str]] | None], key: str = "doc_id") -> DataFrame:
    """(key, rules): for each document, a bit set of the rules whose query its postings satisfy."""
    clauses = [
        F.struct(F.lit(gram).alias("trigram"), F.lit(rule).alias("rule"), F.lit(clause).alias("clause"), F.lit(1 << bit).cast("long").alias("bit"), F.lit((1 << len(grams)) - 1).cast("long").alias("wanted"))
        for rule, query in enumerate(queries)
        for clause, grams in enumerate(query or [])
        for bit, gram in enumerate(sorted(grams))
    ]
    if len(queries) > 62 or any(len(g) > 62 for q in queries for g in q or []):
        raise ValueError("at most 62 rules, and 62 trigrams in a clause")
    if not clauses:
        return postings.select(key, F.lit(0).cast("long").alias("rules")).filter(F.lit(False))
    wanted = postings.sparkSession.range(1).select(F.inline(F.array(*clauses)))
    hits = postings.join(F.broadcast(wanted), "trigram").groupBy(key, "rule", "clause", "wanted").agg(F.bit_or("bit").alias("held"))
    return hits.filter("held = wanted").select(key, F.expr("shiftleft(1L, rule)").alias("bit")).groupBy(key).agg(F.bit_or("bit").alias("rules"))


def _spans(text: Column, rule: SecretRule, kind_no: int) -> Column:
    """array<struct<start, kind_no, kind, end>> of a rule's matches, in code points.

    What lies between the matches comes from split, the matches from regexp_extract_all; a running sum
    of their lengths gives the positions.
    """
    found = F.struct(
        F.split(text, rule.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("values"),
    )

    def positions(s: Column) -> Column:
        start_state = F.struct(F.lit(0).alias("at"), F.array().cast(_NO_SPANS).alias("out"))

        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.element_at(s["gaps"], i))
            end = start + F.length(F.element_at(s["hits"], i))
            span = F.struct(start.alias("start"), F.lit(kind_no).alias("kind_no"), F.lit(rule.kind).alias("kind"), end.alias("end"))
            kept = F.length(F.element_at(s["values"], i)) >= rule.at_least
            return F.struct(end.alias("at"), F.when(kept, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

        return F.aggregate(F.sequence(F.lit(1), F.size(s["hits"])), start_state, step, lambda state: state["out"])

    if rule.closes:
        return _block_spans(text, rule, kind_no)
    if not rule.group and re_class_run(rule.pattern):  # shorter runs need no positions
        long_run = SecretRule(rule.kind, rule.pattern[:-1] + f"{{{rule.at_least},}}")
        return F.when(text.rlike(long_run.pattern), _spans(text, SecretRule(rule.kind, f"(?:{long_run.pattern})"), kind_no)).otherwise(F.array().cast(_NO_SPANS))
    return F.when(text.rlike(rule.pattern), F.transform(F.array(found), positions)[0]).otherwise(F.array().cast(_NO_SPANS))


_BASE64 = "[A-Za-z0-9+/]"
_BREAK = r"[ \t\n\x0B\f\r\\]"
_HEAD, _BODY, _TAIL, _DONE = range(4)


def armor_length(text: Column) -> Column:
    """Characters from the start of `text` to the end of the key that it starts with, 0 if it starts with none.

    Words between blanks, line ends and backslashes are folded one by one. Words without a letter or digit are marks of comments or
    quotes. At the head, lines `Name: value` may stand; the body is words of 32 or more base64 characters, by marks or not. A shorter word ends
    it: one alone on its line, or one with padding, after which a checksum or more body can follow.
    """
    words = F.regexp_extract_all(text, F.lit(f"[^{_BREAK[1:-1]}]*{_BREAK}?"), F.lit(0))
    begin = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("end"), F.lit(_HEAD).alias("mode"), F.lit(False).alias("field"), F.lit(False).alias("fresh"), F.lit(False).alias("escaped"),
    )

    def step(now: Column, piece: Column) -> Column:
        blank_end = piece.rlike(f"{_BREAK}$")
        last = F.when(blank_end, F.right(piece, F.lit(1))).otherwise("")
        whole = F.when(blank_end, F.left(piece, F.length(piece) - 1)).otherwise(piece)
        word = F.when(now["escaped"], F.regexp_replace(whole, "^[rnt]", "")).otherwise(whole)
        word_at = now["at"] + F.length(whole) - F.length(word)
        trimmed = F.regexp_replace(word, r"[^A-Za-z0-9+/=]+$", "")
        core = F.regexp_replace(trimmed, r"^[^A-Za-z0-9+/=]+", "")
        line_end = ~last.isin(" ", "\t")
        mark = ~word.rlike("[A-Za-z0-9]")
        mode, long = now["mode"], core.rlike(f"^{_BASE64}{{32,}}={{0,2}}$")
        lead = F.length(F.regexp_extract(word, f"^[^A-Za-z0-9+/=]*{_BASE64}{{32,}}={{0,2}}", 0))
        short = F.when(now["fresh"] & line_end, core.rlike("^[A-Za-z0-9+/=]+$")).otherwise(core.rlike(f"^{_BASE64}+={{1,2}}$"))
        name = now["fresh"] & word.rlike("^[^A-Za-z0-9]*[A-Z][A-Za-z0-9-]*:$")
        after = (
            F.when(mark, mode)
            .when((mode == _HEAD) & now["field"], mode)
            .when(long, F.lit(_BODY))
            .when(lead > 0, F.lit(_DONE))
            .when((mode == _HEAD) & name, mode)
            .when((mode == _BODY) & short, F.lit(_TAIL))
            .otherwise(F.lit(_DONE))
        )
        held = ~mark & ~((mode == _HEAD) & now["field"])
        checksum = (mode == _TAIL) & core.rlike(f"^={_BASE64}{{4}}$")
        end = F.when(held & (long | ((mode == _BODY) & (lead == 0) & short) | checksum), word_at + F.length(trimmed)).when(held & (lead > 0), word_at + lead).otherwise(now["end"])
        return F.struct(
            (now["at"] + F.length(piece)).alias("at"), end.alias("end"), after.alias("mode"), ((now["field"] | (~mark & name)) & ~line_end).alias("field"),
            (line_end | (now["fresh"] & mark)).alias("fresh"), (last == "\\").alias("escaped"),
        )

    return F.aggregate(words, begin, lambda now, piece: F.when(now["mode"] == _DONE, now).otherwise(step(now, piece)), lambda now: now["end"])


def _block_spans(text: Column, rule: SecretRule, kind_no: int) -> Column:
    """Spans of a rule with `closes`: opening and closing marks are found together and paired by position."""
    either = f"(?:{rule.pattern})|(?:{rule.closes})"
    found = F.struct(F.split(text, either, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(either), F.lit(0)).alias("hits"))

    def positions(s: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            hit, rest = F.element_at(s["hits"], i), F.element_at(s["gaps"], i + 1)
            start = state["at"] + F.length(F.element_at(s["gaps"], i))
            after = start + F.length(hit)
            closing = F.try_element_at(s["hits"], i + 1)
            closed = closing.isNotNull() & ~closing.rlike(rule.pattern) & ~F.contains(rest, F.lit("-----"))
            end = after + F.when(closed, F.length(rest) + F.length(closing)).otherwise(armor_length(rest))
            span = F.struct(start.alias("start"), F.lit(kind_no).alias("kind_no"), F.lit(rule.kind).alias("kind"), end.alias("end"))
            return F.struct(after.alias("at"), F.when(hit.rlike(rule.pattern), F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

        start_state = F.struct(F.lit(0).alias("at"), F.array().cast(_NO_SPANS).alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.size(s["hits"])), start_state, step, lambda state: state["out"])

    return F.when(text.rlike(rule.pattern), F.transform(F.array(found), positions)[0]).otherwise(F.array().cast(_NO_SPANS))


def re_class_run(pattern: str) -> bool:
    """Whether a regex is one character class, repeated: its matches are the whole runs of the class."""
    tokens = list(parser.parse(pattern))
    return len(tokens) == 1 and tokens[0][0] is node.MAX_REPEAT and tokens[0][1][:2] == (1, node.MAXREPEAT) and [t[0] for t in tokens[0][1][2]] == [node.IN]


def scan_secrets(docs: DataFrame, rules: list[SecretRule] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of `docs` with `secrets`: array of (start, kind_no, kind, end), by start and rule.

    Positions are code points, ends exclusive. Null and empty texts have no spans. Keys may be null or
    repeated: candidates are found by key and verified on each row's own text. A column of `docs`
    named secrets is replaced.
    """
    queries = [trigram_query(rule.pattern) for rule in rules]
    grams = sorted(set().union(*(g for q in queries for g in q or [])))
    found = keep(candidates(build_postings(docs, grams, text, key), queries, key))
    probable, rest = split_by_keys(docs.drop("secrets"), found, key)
    own = found.select(F.col(key).alias("__key"), F.col("rules").alias("__rules"))
    probable = probable.join(own, F.col(key).eqNullSafe(F.col("__key")), "left")
    none = F.array().cast(_NO_SPANS)
    by_rule = {kind_no: _spans(F.col(text), rule, kind_no) for kind_no, rule in enumerate(rules)}
    on_all = [spans for kind_no, spans in by_rule.items() if queries[kind_no] is None]
    is_candidate = lambda kind_no: F.coalesce("__rules", F.lit(0)).bitwiseAND(F.lit(1 << kind_no)) != 0
    verified = [F.when(is_candidate(kind_no), spans).otherwise(none) for kind_no, spans in by_rule.items() if queries[kind_no] is not None]
    in_order = lambda parts: F.array_sort(F.concat(*parts)) if parts else none
    probable = probable.withColumn("secrets", in_order(on_all + verified)).drop("__key", "__rules")
    return probable.unionByName(rest.withColumn("secrets", in_order(on_all)))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with each span replaced by a mask; overlapping spans share one. Null stays null."""
    def step(state: Column, s: Column) -> Column:
        plain = F.concat(state["out"], F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mask))
        grown = F.greatest(state["at"], s["end"])
        return F.struct(grown.alias("at"), F.when(s["start"] >= state["at"], plain).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
