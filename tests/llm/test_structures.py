"""Chat formatting, the conversation prefix trie and the Merkle manifest, against brute force and exact round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from funnelwise.llm import manifest as merkle
from funnelwise.llm import prefixes
from funnelwise.llm.chat import ChatTemplate, escape, format_conversations, loss_text, read_turns, unescape
from funnelwise.llm.prefixes import conversation_trie

from .conftest import SF_DIR, edge_rows, values

SHAPE = "conv_id long, turn long, role string, text string"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def edge_turns() -> list[tuple]:
    """Null ids, turns, roles and texts, empty texts, marks and escapes inside texts and roles, repeated rows, copies, a long conversation."""
    marks = ["\\", "<turn ", "</turn>", ">\n", "\\b", "\\o", "<turn user>\n", "</", "<", "<turn <turn ", "</turn></turn>", "\\\\o", "x</turn", ">"]
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "é😀"), (2, None, None, None), (2, 0, "user", ""), (2, 1, "assistant", ""), (3, 0, "assistant", "first"), (3, 1, "assistant", "again")]
    rows += [(4, i, ("user", "assistant")[i % 2], t + marks[i - 1]) for i, t in enumerate(marks)]
    rows += [(5, i, t, "odd role") for i, t in enumerate(marks)]
    rows += [(6, 0, "user", "same"), (6, 0, "user", "same"), (7, 0, "system", "s"), (7, 1, "user", "u"), (7, 2, "assistant", "a"), (7, 3, "user", "u")]
    rows += [(None, 0, "user", "lost"), (None, 1, "assistant", "also"), (8, 0, "user", "x" * 200_000), (8, 1, "assistant", "y" * 100_000)]
    rows += [(9, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(700)]
    return rows


def table(spark, rows):
    names = ["fault", "segments", "formatted", "conv", "position", "chars", "t1", "p1", "block", "turns", "n_turns", "total"]
    return spark.createDataFrame(rows, SHAPE).repartition(3).withColumns({n: F.lit(f"own {n}") for n in names})


# Chat formatting


def by_conversation(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in out.items()}


def slow_fault(roles, template):
    state = "start"
    for i, role in enumerate(roles):
        state = template.machine.get(state, {}).get(role)
        if state is None:
            return i + 1
    return None if state in template.final else len(roles) + 1


TEMPLATES = [
    ChatTemplate(),
    ChatTemplate("<|im_start|>", "\n", "<|im_end|>", "\n"),
    ChatTemplate("[>", "|", "<]", "", ("assistant", "tool"), {"start": {"user": "asked"}, "asked": {"assistant": "said", "tool": "asked"}, "said": {"user": "asked"}}, ("said", "asked")),
]


@pytest.mark.parametrize("template", TEMPLATES)
def test_chat_round_trip_and_loss(spark, template):
    rows = edge_turns() + [(10, 0, "user", "q"), (10, 1, "tool", "r"), (10, 2, "assistant", "s")]
    made = format_conversations(table(spark, rows), template).withColumns({"read": read_turns(F.col("formatted"), template), "loss": loss_text(F.col("segments"), template)})
    got = {r.conv_id: r for r in made.collect()}
    want = by_conversation(rows)
    assert got.keys() == want.keys()
    for c, turns in want.items():
        r = got[c]
        assert [tuple(t) for t in r["read"]] == turns and r.n_turns == len(turns)
        assert r.loss == "".join(t for role, t in turns if role in template.loss_roles)
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.fault == slow_fault([role for role, _ in turns], template)
        for s in r.segments[1::3]:
            assert template.open not in s.text and template.close not in s.text


def test_chat_escape_is_reversible_on_random_texts(spark):
    rnd, template = random.Random(5), ChatTemplate()
    pieces = ["\\", "<", "turn", " ", "/", ">", "\n", "b", "o", "c", "r", "</turn>", "<turn ", "é"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(0, 12))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t"), template, role=True).alias("e"))
    for r in rows.withColumn("u", unescape(F.col("e"), template)).collect():
        assert r.u == r.t and not any(m in r.e for m in (template.open, template.close, template.after_role))


def test_chat_of_nothing_and_bad_templates(spark):
    assert format_conversations(spark.createDataFrame([], SHAPE)).count() == 0
    for bad in ({"open": ""}, {"open": "\\x"}, {"close": "cut"}, {"after_role": "::"}, {"close": "<turn <"}, {"machine": {"a\nb": {}}}):
        with pytest.raises(ValueError):
            ChatTemplate(**bad)


def test_chat_plan_has_no_python(spark):
    made = format_conversations(spark.read.parquet(f"{SF_DIR}/conversations.parquet")).withColumn("read", read_turns(F.col("formatted")))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow")) and plan.count("Exchange") == 1


# Prefix trie


def slow_trie(rows, families):
    convs = {c: turns for c, turns in by_conversation(rows).items() if c is not None}
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = convs.get(c - c % 100, [])[:h] + turns[h:] if families else turns
    member, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            member[tuple(turns[:d])].append(c)
    for path in member:
        if path:
            kids[path[:-1]] += 1
    for path, own in member.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        ((min(own), len(path), min(member[path[:-1]]) if path else None, len(own), kids[path], leaves[path], saved[path],
          sha(",".join(map(str, sorted(c for c in own if len(rebuilt[c]) == len(path)))))) for path, own in member.items()),
        key=repr,
    )


def family_turns(seed: int) -> list[tuple]:
    """Conversations of few different turns: shared prefixes, copies, prefixes of others, absent and short family heads."""
    rnd = random.Random(seed)
    rows = []
    for c in [0, 3, 5, 17, 99, 100, 101, 150, 199, *range(201, 230), 300, 301, 305, *range(400, 470)]:
        for turn in range(rnd.choice([1, 2, 4, 5, 8, 9, 11])):
            rows.append((c, turn, ("user", "assistant")[turn % 2], f"{turn} {rnd.choice('aaaab')}"))
    return rows


@pytest.mark.parametrize("families, block, chunk", [(True, 4, 4096), (True, 1, 4), (False, 4, 4), (True, 3, 6)])
def test_trie_of_families(spark, monkeypatch, families, block, chunk):
    monkeypatch.setattr(prefixes, "CHUNK_TURNS", chunk)
    monkeypatch.setattr(prefixes, "PIECE_IDS", 3)
    rows = family_turns(block)
    assert values(conversation_trie(table(spark, rows), families=families, block=block)) == slow_trie(rows, families)


def test_trie_of_edges(spark):
    rows = [r for r in edge_turns() if r[0] not in (8,)] + [(8, 0, "user", "x" * 20_000)]
    assert values(conversation_trie(table(spark, rows), families=True)) == slow_trie(rows, True)
    assert values(conversation_trie(table(spark, rows))) == slow_trie(rows, False)


def test_trie_of_many_copies_and_of_nothing(spark):
    rows = [(c, t, "user", "same") for c in range(0, 3000) for t in range(2)] + [(c, t, "user", f"{min(t, 1)}") for c in range(3000, 3040) for t in range(3)]
    assert values(conversation_trie(table(spark, rows))) == slow_trie(rows, False)
    assert conversation_trie(spark.createDataFrame([], SHAPE), families=True).count() == 0
    turnless = [(101, 0, "user", "x")]  # its h is above 0 and its family's head is absent
    assert zlib.crc32(b"101") % 6 > 0
    assert values(conversation_trie(table(spark, turnless), families=True)) == slow_trie(turnless, True)


def test_trie_ties_do_not_depend_on_the_input_order(spark):
    rows = [(c, 0, "user", t) for c in (1, 2) for t in "abcdef"]
    both = [values(conversation_trie(spark.createDataFrame(r, SHAPE).repartition(2))) for r in (rows, rows[::-1])]
    assert both[0] == both[1] and len(both[0]) == 7


# Merkle manifest


def framed(record) -> str:
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in record)


def slow_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def slow_path(levels, i):
    out = []
    for level in levels[:-1]:
        run, at = level[i // 8 * 8 : i // 8 * 8 + 8], i % 8
        out += ["".join(run[:at]), "".join(run[at + 1 :])]
        i //= 8
    return out


def slow_manifest(rows):
    """Rows of (doc_id, text, lang, source, n_chars)."""
    by = defaultdict(list)
    for i, t, lang, source, n in rows:
        by[lang].append((i is not None, i or 0, sha(framed((i, source, lang, n, t))), (i, source, lang, n, t)))
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: slow_levels([r[2] for r in sorted(by[g], key=lambda r: r[:3])]) for g in langs}
    top, out = slow_levels([trees[g][-1][0] for g in langs]), []
    for k, g in enumerate(langs):
        for at, (_, _, leaf, r) in enumerate(sorted(by[g], key=lambda r: r[:3])):
            path, shown = slow_path(trees[g], at) + slow_path(top, k), leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                shown = sha(framed((*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]))))
            folded = shown
            for left, right in zip(path[::2], path[1::2]):
                folded = sha(left, folded, right)
            out.append((r[0], leaf, trees[g][-1][0], top[-1][0], sha(*path), folded, folded == top[-1][0], merkle.log_position(0, at, len(trees[g][0]))))
    return sorted(out, key=repr)


def proven(docs):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower)
    return merkle.prove(merkle.build_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"text": claim}), "doc_id")


def test_manifest_of_edges(edges, nothing):
    assert values(proven(edges)) == slow_manifest(edge_rows())
    assert proven(nothing).count() == 0


def many_rows(n, seed=0):
    rnd = random.Random(seed)
    langs = [None, "en", "en", "en", "", "é", "zz", *[f"l{i}" for i in range(70)]]
    rows = [(i, rnd.choice(["Upper A", "lower", "", None]) and f"Text {i}", rnd.choice(langs), None, i % 7) for i in range(n)]
    return rows + [(5, "Hot ID", "en", "s", j) for j in range(n // 3)] + [(6, "Same row", "en", "s", 1)] * (n // 3)


@pytest.mark.parametrize("levels", [1, 2])
def test_manifest_over_rounds_of_builders_hot_ids_and_equal_rows(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BUILDER_LEVELS", levels)
    monkeypatch.setattr(merkle, "BUILDER_LEAVES", 8**levels)
    rows = many_rows(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert values(proven(docs)) == slow_manifest(rows)


@pytest.mark.parametrize("n", [1, 9, 64, 65])
def test_log_is_postorder_without_gaps(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "BUILDER_LEVELS", 1)
    monkeypatch.setattr(merkle, "BUILDER_LEAVES", 8)
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(n)], "doc_id long, text string")
    made = merkle.build_manifest(docs.withColumn("one", F.lit("g")), ["doc_id", "text"], "one", "doc_id")
    got = {r.position: (r.level, r["index"], r.digest.hex()) for r in made.trees.log().collect()}
    levels = slow_levels([sha(framed((i, f"t{i}"))) for i in range(n)])
    want = []

    def visit(level, i):
        if level:
            for child in range(8 * i, min(8 * i + 8, len(levels[level - 1]))):
                visit(level - 1, child)
        want.append((level, i, levels[level][i]))

    visit(len(levels) - 1, 0)
    assert got == dict(enumerate(want))
