"""DuckDB SQL for the registered queries that SQL can express.

No SQL: op3 (byte context trees), op5 and op7 (tokenizers) and the pipeline, which contains them; the
tests hold those against brute force, exact round trips and held-out accuracy.
"""

from __future__ import annotations

from .chat import _CODES, _ESCAPE, START, ChatTemplate
from .licenses import TEMPLATES
from .quality import RepetitionRules
from .queries import PROBE
from .secrets import BASE_RULES, RULES

WORDS = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: doc_id, p (from 1) and x of every word; t is an expression of the text.
def words(t: str = "text") -> str:
    return f"SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM (SELECT doc_id, regexp_extract_all({t}, '{WORDS}') AS w FROM documents)"


def grams(n: int) -> str:
    frame = f"OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)"
    return f"SELECT doc_id, p, g FROM (SELECT doc_id, p, list(x) {frame} AS g FROM word) WHERE len(g) = {n}"


def _quality() -> str:
    rules, parts, joins = RepetitionRules(), [], []
    for n in (3, *(n for n, _ in rules.ngram_limits)):
        parts.append(f"""gram{n} AS ({grams(n)}),
twice{n} AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM gram{n}) WHERE c > 1),
inside{n} AS (SELECT DISTINCT doc_id, p + k AS p FROM twice{n}, range({n}) r(k)),
cover{n} AS (SELECT doc_id, count(*) AS words, sum(length(x)) AS chars FROM inside{n} JOIN word USING (doc_id, p) GROUP BY doc_id)""")
        joins.append(f"LEFT JOIN cover{n} c{n} USING (doc_id)")
    measures = ", ".join(f"coalesce(c{n}.chars, 0)::BIGINT AS chars_repeated_{n}" for n, _ in rules.ngram_limits)
    worst = ", ".join(f"chars_repeated_{n} / greatest(word_chars, 1)::DOUBLE / {limit}::DOUBLE" for n, limit in rules.ngram_limits)
    return f"""WITH word AS MATERIALIZED ({words()}),
{", ".join(parts)},
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents),
lines AS (SELECT doc_id, l, count(*) AS c FROM line WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY ALL),
again AS (SELECT doc_id, sum(c - 1) AS n, sum((c - 1) * length(l)) AS chars FROM lines GROUP BY doc_id),
total AS (SELECT doc_id, count(*) AS n, sum(length(x)) AS chars FROM word GROUP BY doc_id),
measure AS (SELECT doc_id, coalesce(total.n, 0)::BIGINT AS n_words, coalesce(total.chars, 0)::BIGINT AS word_chars,
  coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols, coalesce(again.n, 0)::BIGINT AS n_dup_lines,
  coalesce(c3.words, 0)::BIGINT AS n_repeat_words, coalesce(again.chars, 0)::BIGINT AS dup_line_chars, coalesce(length(text), 0) AS all_chars, {measures}
  FROM documents LEFT JOIN total USING (doc_id) LEFT JOIN again USING (doc_id) {" ".join(joins)}),
judged AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {100 * rules.max_repeat_words} * n_words AS base_failed,
  greatest(n_symbols / greatest(n_words, 1)::DOUBLE / {rules.max_symbols_per_word}::DOUBLE, {worst}, dup_line_chars / greatest(all_chars, 1)::DOUBLE / {rules.max_line_chars}::DOUBLE) AS repetition FROM measure)
SELECT * EXCLUDE (all_chars), NOT base_failed AND repetition <= 1 AS kept FROM judged"""


_SUBSTRINGS = f"""WITH word AS MATERIALIZED ({words()}),
gram AS ({grams(13)}),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY g) AS first FROM gram) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM later, range(13) r(k)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
total AS (SELECT doc_id, count(*) AS n FROM word GROUP BY doc_id)
SELECT doc_id, coalesce(total.n, 0)::BIGINT AS n_words, (coalesce(total.n, 0) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM documents LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_REACH = """reach AS (SELECT id, id AS r FROM node UNION SELECT reach.id, b FROM reach JOIN link ON a = r),
root AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

_EMBEDDINGS = f"""WITH RECURSIVE sound AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
node AS (SELECT vec_id AS id FROM embeddings),
link AS (SELECT p.vec_id AS a, q.vec_id AS b FROM sound p JOIN sound q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v) AND list_cosine_similarity(p.v, q.v) >= 0.98),
{_REACH}, n AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
SELECT root.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, root.id = component_id AS kept FROM root LEFT JOIN n USING (id)"""

_NEAR = f"""WITH RECURSIVE word AS MATERIALIZED ({words(f"translate(text, '{_UPPER}', '{_LOWER}')")}),
short AS (SELECT doc_id, list(x ORDER BY p) AS g FROM word GROUP BY doc_id HAVING count(*) < 5),
shingle AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM ({grams(5)} UNION ALL SELECT doc_id, 0, g FROM short)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM shingle p JOIN shingle q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY ALL),
node AS (SELECT doc_id AS id FROM documents),
link AS MATERIALIZED (SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
{_REACH}
SELECT id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, id = component_id AS kept FROM root LEFT JOIN size ON doc_id = id"""


def _secrets() -> str:
    kinds = []
    for no, rule in enumerate(RULES):
        # blocks that are closed; those that are not are folded word by word, which the tests hold against brute force
        pattern = quoted(rule.pattern if rule.closes is None else f"{rule.pattern}(?:(?:[^-]|-{{1,4}}[^-])*{rule.closes})?")
        kinds.append(f"""SELECT doc_id, {no} AS no, '{rule.kind}' AS kind, i, {rule.at_least} AS least, gaps, hits, vals[i] AS val FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
  SELECT doc_id, regexp_split_to_array(text, {pattern}) AS gaps, regexp_extract_all(text, {pattern}, 0) AS hits, regexp_extract_all(text, {pattern}, {rule.group}) AS vals FROM documents))""")
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    shown = "kind || ':' || s || ':' || e, ',' ORDER BY s, no, e"
    return f"""WITH hit AS ({" UNION ALL ".join(kinds)}),
span AS (SELECT doc_id, no, kind, list_sum(list_transform(gaps[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0)::BIGINT AS s, length(hits[i]) AS n FROM hit WHERE length(val) >= least),
ended AS (SELECT *, s + n AS e FROM span),
found AS (SELECT doc_id, {counts}, string_agg({shown}) FILTER (WHERE no < {len(BASE_RULES)}) AS base, string_agg({shown}) AS spans FROM ended GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN found USING (doc_id)"""


def _licenses(least: float = 0.75) -> str:
    norm = lambda t: f"regexp_extract_all(translate({t}, '{_UPPER}', '{_LOWER}'), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"
    pairs = lambda w: f"list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    templates = " UNION ALL ".join(f"SELECT {quoted(name)} AS license, {norm(quoted(text))} AS w" for name, text in TEMPLATES.items())
    split = lambda by: f"SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS t FROM (SELECT doc_id, string_split(text, {by}) AS l FROM documents)"
    placed = lambda kind: f"SELECT doc_id, w, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS e FROM (SELECT doc_id, i, {norm('t')} AS w FROM ({kind}))"
    return f"""WITH template AS (SELECT license, {pairs("w")} AS b FROM ({templates})),
unit AS (SELECT doc_id, e - len(w) AS s, e, any_value(w) AS w FROM ({placed(split("chr(10)"))} UNION ALL {placed(split("chr(10) || chr(10)"))} UNION ALL {placed("SELECT doc_id, 1 AS i, text AS t FROM documents")}) WHERE len(w) >= 2 GROUP BY ALL),
pair AS (SELECT doc_id, s, e, {pairs("w")} AS b FROM unit),
scored AS (SELECT doc_id, s, e, license, 2 * len(list_intersect(pair.b, template.b)) / (len(pair.b) + len(template.b))::DOUBLE AS dice FROM pair JOIN template ON 2 * least(len(pair.b), len(template.b)) >= {least} * (len(pair.b) + len(template.b)))
SELECT doc_id, s AS start, e AS "end", license, dice FROM scored WHERE dice >= {least} QUALIFY row_number() OVER (PARTITION BY doc_id, s, e ORDER BY dice DESC, license) = 1"""


def _apportioned(name: str, rows: str, group: str, weight: str, order: str, cap: str = "cap") -> str:
    """Seats by highest quotients: certain ones first, then the open ones. `rows` has house and the cap."""
    by, among = f"PARTITION BY {group}", f"{group}, {order}" if group != "true" else order
    return f"""{name}0 AS (SELECT *, count(*) OVER ({by}) AS n, sum({weight}) OVER ({by}) AS tot FROM ({rows})),
{name}1 AS (SELECT *, least({cap}, CASE WHEN tot > 0 THEN floor({weight} * greatest(house - n, 0) / tot::DOUBLE + 0.5)::BIGINT ELSE 0 END) AS sure FROM {name}0),
{name}2 AS (SELECT *, house - sum(sure) OVER ({by}) AS open FROM {name}1),
{name}3 AS (SELECT *, unnest(range(1, least({cap} - sure, open)::BIGINT + 1)) AS k FROM {name}2),
{name}4 AS (SELECT {among}, count(*) AS won FROM (SELECT *, row_number() OVER ({by} ORDER BY {weight} / (2 * (sure + k) - 1)::DOUBLE DESC, {order}) AS r FROM {name}3 WHERE {weight} > 0) WHERE r <= open GROUP BY ALL),
{name} AS (SELECT {name}2.*, sure + coalesce(won, 0) AS quota FROM {name}2 LEFT JOIN {name}4 USING ({among}))"""


def _mix(seed: int = 17, block: int = 16, shard_words: int = 1 << 17, together: int = 1024) -> str:
    number = lambda digest: f"('0x' || substr({digest}, 1, 8))::BIGINT"
    inside = lambda at: f"least(greatest({at} - (e - size), 0), size)"
    return f"""WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS size, md5(text) AS content FROM documents),
total AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS position FROM total),
weighted AS (SELECT *, [5.0, 2.0, 1.0][((position - 1) % 3 + 1)::INT]::DOUBLE AS weight, 2.0 * source_size AS cap FROM placed),
level AS (SELECT max((1.5 * (SELECT sum(source_size) FROM total) - capped) / ((SELECT sum(weight) FROM weighted) - used)) AS level FROM (
  SELECT coalesce(sum(cap) OVER w, 0)::DOUBLE AS capped, coalesce(sum(weight) OVER w, 0)::DOUBLE AS used FROM weighted WINDOW w AS (ORDER BY cap / weight, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
target AS (SELECT source, position, source_size, greatest(least(cap::DOUBLE, weight * level), 0) AS target FROM weighted, level),
dealt AS (SELECT sized.*, position, source_size, target, md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size || ':' || coalesce(content, 'null')) AS digest FROM sized JOIN target ON sized.source IS NOT DISTINCT FROM target.source),
sharded AS (SELECT *, {number("digest")} % greatest(ceil(source_size / {shard_words}.0), 1)::BIGINT AS shard FROM dealt),
shards AS (SELECT position, shard, floor(shard / {together}.0)::BIGINT AS part, sum(size)::BIGINT AS words, 2 * ceil(sum(size) / {block}.0)::BIGINT AS cap FROM sharded GROUP BY ALL),
parts AS (SELECT position, part, sum(words)::BIGINT AS words, sum(cap)::BIGINT AS cap FROM shards GROUP BY ALL),
{_apportioned("whole", f"SELECT position, target, sum(cap)::BIGINT AS cap, round(sum(target) OVER () / {block}.0)::BIGINT AS house FROM parts JOIN target USING (position) GROUP BY position, target", "true", "target", "position")},
{_apportioned("cut", "SELECT parts.*, quota AS house FROM parts JOIN whole USING (position)", "position", "words", "part")},
{_apportioned("given", "SELECT shards.*, quota AS house FROM shards JOIN cut USING (position, part)", "position, part", "words", "shard")},
ordered AS (SELECT *, sum(size) OVER (PARTITION BY position, shard ORDER BY substr(digest, 9, 24), doc_id, size, content ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM sharded),
quota AS (SELECT ordered.*, quota::BIGINT AS q, greatest(ceil(words / {block}.0)::BIGINT, 1) AS blocks FROM ordered JOIN given USING (position, shard)),
first AS (SELECT *, {number(f"md5('{seed}:first:' || position || ':' || shard)")} % blocks AS f, q % blocks AS extra FROM quota)
SELECT doc_id, size::BIGINT AS size, source_size, target, ((q // blocks) * size + {inside(f"(f + extra) * {block}")} - {inside(f"f * {block}")} + {inside(f"(f + extra - blocks) * {block}")})::BIGINT AS taken FROM first"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), lambda a, b: {byte}), 4294967295::BIGINT)"


def _chat(template: ChatTemplate = ChatTemplate()) -> str:
    def escaped(text: str, marks: list[str]) -> str:
        for mark, code in zip(marks, _CODES):
            text = f"replace({text}, {quoted(mark)}, {quoted(_ESCAPE + code)})"
        return text

    marks = [_ESCAPE, template.open, template.close, template.after_role]
    steps = ", ".join(f"({quoted(state)}, {quoted(role)})" for state, step in template.machine.items() for role in step)
    written = " || ".join([quoted(template.open), escaped("role", marks), quoted(template.after_role), escaped("text", marks[:3]), quoted(template.close + template.between)])
    roles = lambda names: ", ".join(map(quoted, names))
    return f"""WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, role, {quoted(PROBE[1])} FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, role)),
turns AS (SELECT *, row_number() OVER w AS p, lag(role, 1, '{START}') OVER w AS state FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role IN ({roles(template.loss_roles)})), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (WHERE role IN ({roles(template.loss_roles)})), '')) AS loss_sha256,
  sum(length({written}))::BIGINT AS formatted_chars,
  coalesce(min(p) FILTER (WHERE (state, role) NOT IN ({steps})), CASE WHEN max_by(role, p) NOT IN ({roles(template.final)}) THEN count(*) + 1 END)::BIGINT AS fault
FROM turns GROUP BY conv_id"""


_TRIE = f"""WITH said AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS x
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(x ORDER BY p) AS l, {_crc32("any_value(c)::VARCHAR")} % 6 AS h FROM said GROUP BY c),
rebuilt AS (SELECT own.c, CASE WHEN top.c IS NULL THEN own.l[own.h + 1:] ELSE list_concat(top.l[1:own.h], own.l[own.h + 1:]) END AS l FROM own LEFT JOIN own top ON top.c = own.c - own.c % 100),
member AS (SELECT c, unnest(range(0, len(l) + 1)) AS d, l FROM rebuilt),
node AS MATERIALIZED (SELECT d, l[1:d] AS path, min(c) AS conv_id, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(l) = d), '') AS ends FROM member GROUP BY 1, 2),
kids AS (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS k FROM node WHERE d > 0 GROUP BY 1, 2),
grown AS (SELECT node.*, coalesce(k, 0) AS k FROM node LEFT JOIN kids USING (d, path)),
above AS (SELECT path, k, CASE WHEN d > 0 THEN (n - 1) * length(path[d].t) ELSE 0 END AS saved, unnest(range(0, d + 1)) AS a FROM grown),
under AS (SELECT a AS d, path[1:a] AS path, count(*) FILTER (WHERE k = 0) AS n_leaves, sum(saved) AS saved FROM above GROUP BY 1, 2)
SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n AS n_convs, f.k AS n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM grown f JOIN under USING (d, path) LEFT JOIN node up ON up.d = f.d - 1 AND up.path = f.path[1:f.d - 1]"""


def _levels(name: str, rows: str, levels: int) -> str:
    """Trees of (g, i, d): {name}0 has the leaves, {name}k the nodes after k levels; runs_{name}k their runs of eight."""
    parts = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM ({rows}))"]
    for k in range(levels):
        parts.append(f"runs_{name}{k} AS (SELECT g, i // 8 AS i, list(d ORDER BY i) AS run, any_value(n) AS n FROM {name}{k} GROUP BY g, i // 8)")
        parts.append(f"{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM (SELECT g, i, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS d FROM runs_{name}{k}))")
    return ",\n".join(parts)


def _climb(name: str, start: str, levels: int) -> str:
    """{name}_up: the rows of `start` (g, i, shown, proof and others) with what their siblings give, folded over all levels."""
    parts, last = [], start
    for k in range(levels):
        left, right = "array_to_string(run[1:s.i % 8], '')", "array_to_string(run[s.i % 8 + 2:], '')"
        parts.append(f"""{name}_up{k} AS (SELECT s.* REPLACE (s.i // 8 AS i, CASE WHEN n > 1 THEN sha256({left} || shown || {right}) ELSE shown END AS shown,
  CASE WHEN n > 1 THEN proof || {left} || {right} ELSE proof END AS proof) FROM {last} s JOIN runs_{name}{k} r ON r.g IS NOT DISTINCT FROM s.g AND r.i = s.i // 8)""")
        last = f"{name}_up{k}"
    return ",\n".join(parts)


def _manifest(levels: int = 7, top_levels: int = 3) -> str:
    framed = lambda v: f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(framed(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    return f"""WITH leaf AS (SELECT doc_id, lang AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf, CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN tampered ELSE leaf END AS shown
  FROM (SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf(lower)} AS tampered FROM documents)),
{_levels("a", "SELECT g, i, leaf AS d FROM leaf", levels)},
subroot AS (SELECT g AS lang, d, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i FROM a{levels}),
{_levels("b", "SELECT 0 AS g, i, d FROM subroot", top_levels)},
start AS (SELECT doc_id, g, i, i AS pos, leaf, shown, '' AS proof FROM leaf),
{_climb("a", "start", levels)},
middle AS (SELECT u.doc_id, u.pos, u.leaf, u.shown, u.proof, subroot.d AS subroot, 0 AS g, subroot.i FROM a_up{levels - 1} u JOIN subroot ON u.g IS NOT DISTINCT FROM lang),
{_climb("b", "middle", top_levels)}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, shown AS folded_root, shown = d AS verified,
  ({" + ".join(f"pos // {8 ** m}" for m in range(levels + 1))})::BIGINT AS log_position
FROM b_up{top_levels - 1} JOIN (SELECT d FROM b{top_levels}) ON true"""


ORACLES: dict[str, str] = {
    "op1_repetition_quality": _quality(),
    "op2_substring_dedup": _SUBSTRINGS,
    "op4_embedding_near_dedup": _EMBEDDINGS,
    "op6_minhash_near_dedup": _NEAR,
    "op8_secret_scan": _secrets(),
    "op9_license_scan": _licenses(),
    "op10_source_mix": _mix(),
    "op11_chat_format": _chat(),
    "op12_prefix_trie": _TRIE,
    "op13_merkle_manifest": _manifest(),
}
