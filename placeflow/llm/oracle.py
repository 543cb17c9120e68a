"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from placeflow.llm import chat, quality_rules

ORACLE: dict[str, str] = {}


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _chat_sql() -> str:
    """The digests from the rows; lengths from the template's control strings."""
    t = chat.TEMPLATE
    special = set("\\.[]{}()*+?^$|/")
    pattern = "|".join(m[0].replace("[", r"\[") + r"\\*" + "".join("\\" + c if c in special else c for c in m[1:]) for m in t.marks)
    escaped = lambda x: f"(length({x}) + len(regexp_extract_all({x}, {_q(pattern)})))"
    known = ", ".join(_q(r) for r in t.roles)
    size = "CASE role " + " ".join(f"WHEN {_q(n)} THEN {len(r.before) + len(r.after)}" for n, r in t.roles.items())
    size += f" ELSE {len(t.other.before) + len(t.other.after) + len(t.name_end)} + {escaped('role')} END"
    allowed = " OR ".join(f"(role = {_q(n)} AND state IN ({', '.join(map(_q, r.follows))}))" for n, r in t.roles.items())
    loss = ", ".join(_q(n) for n, r in t.roles.items() if r.loss)
    check = "'</s>[INST] ok [/INST]'"
    return f"""WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {check} UNION ALL SELECT -1, 1, 'assistant', {check}),
placed AS (SELECT *, row_number() OVER w - 1 AS place, lag(role) OVER w AS last FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
states AS (SELECT *, CASE WHEN place = 0 THEN '' WHEN last IN ({known}) THEN last END AS state FROM placed)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role IN ({loss})), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role IN ({loss})), '')) AS loss_sha256,
  CAST({len(t.begin) + len(t.end)} + sum({size} + {escaped('text')}) AS BIGINT) AS formatted_chars,
  bool_and(coalesce({allowed}, false)) AS valid,
  coalesce(min(place) FILTER (WHERE NOT coalesce({allowed}, false)), -1) AS bad_turn
FROM states GROUP BY conv_id"""


def _rules_sql(min_share=0.001, max_char=0.3, max_word=0.9, min_chars=200, min_words=100, min_reference=10_000, max_languages=200) -> str:
    space = r"[\x20\x09-\x0D]"
    names = [*quality_rules.CLASSES, "other"]
    left, steps = "text", []
    for name, pattern in quality_rules.CLASSES.items():
        steps.append((f"length({left})", name))
        left = f"regexp_replace({left}, '{pattern}+', '', 'g')"
    sizes = [s for s, _ in steps] + [f"length({left})"]
    counts = ", ".join(f"CAST({a} - {b} AS BIGINT) AS c_{n}" for n, a, b in zip(names, sizes, sizes[1:])) + f", CAST({sizes[-1]} AS BIGINT) AS c_other"
    term = lambda p, q: (f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"  # noqa: E731
                         f" + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({q} + {p})) ELSE 0 END)")
    n_chars = " + ".join(f"d.c_{n}" for n in names)
    r_chars = " + ".join(f"r.c_{n}" for n in names)
    char_js = " + ".join(term(f"(d.c_{n} / nullif({n_chars}, 0))", f"(r.c_{n} / nullif({r_chars}, 0))") for n in names)
    return f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang FROM documents),
split AS MATERIALIZED (SELECT *, regexp_extract_all(text, '[^{space[1:]}+') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{space[1:]}')) AS lines, {counts} FROM docs),
windows AS (SELECT rid, i, words[i:i + 4] AS w FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
twice AS (SELECT rid, unnest(range(i, i + 5)) AS p FROM (
  SELECT *, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM twice GROUP BY rid),
word_rows AS MATERIALIZED (SELECT rid, lang, unnest(words) AS word FROM split),
word_counts AS (SELECT lang AS ref, word, count(*) AS n FROM word_rows GROUP BY ALL
  UNION ALL SELECT '*', word, count(*) FROM word_rows GROUP BY ALL),
totals AS (SELECT * FROM (SELECT ref, sum(n) AS total FROM word_counts GROUP BY ref HAVING sum(n) >= {min_reference} AND ref <> '*'
  ORDER BY total DESC, ref LIMIT {max_languages}) UNION ALL SELECT ref, sum(n) FROM word_counts WHERE ref = '*' GROUP BY ref),
common AS MATERIALIZED (SELECT w.ref, w.word, w.n, t.total FROM word_counts w JOIN totals t USING (ref) WHERE w.n >= t.total * {min_share}),
per_lang AS (SELECT lang AS ref, {', '.join(f'sum(c_{n}) AS c_{n}' for n in names)} FROM split GROUP BY lang),
ref_chars AS (SELECT * FROM per_lang UNION ALL SELECT '*', {', '.join(f'sum(c_{n})' for n in names)} FROM per_lang),
d AS MATERIALIZED (SELECT s.*, CASE WHEN lang IN (SELECT ref FROM totals WHERE ref <> '*') THEN lang ELSE '*' END AS ref FROM split s),
own AS MATERIALIZED (SELECT rid, word, count(*) AS k FROM word_rows WHERE word IN (SELECT word FROM common) GROUP BY ALL),
hits AS (SELECT d.rid, c.word, c.n, c.total, len(d.words) AS size, coalesce(x.k, 0) AS k
  FROM d JOIN common c USING (ref) LEFT JOIN own x ON x.rid = d.rid AND x.word = c.word WHERE len(d.words) >= {min_words}),
shares AS (SELECT rid, k / size AS p, n / total AS q FROM hits
  UNION ALL SELECT rid, (any_value(size) - sum(k)) / any_value(size), (any_value(total) - sum(n)) / any_value(total) FROM hits GROUP BY rid),
absent AS (SELECT ref, sqrt((sum(n / total) + {term('1.0', '(1 - sum(n / total))')}) / 2) AS js FROM common GROUP BY ref),
word_js AS (SELECT rid, round(sqrt(greatest(sum({term('p', 'q')}) / 2, 0)), 4) AS js FROM shares GROUP BY rid),
base AS (SELECT d.rid, d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, {n_chars} - d.c_space AS word_chars, d.c_symbol AS n_symbols,
  CAST(len(d.lines) - len(list_distinct(d.lines)) AS BIGINT) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words,
  CASE WHEN {n_chars} >= {min_chars} THEN round(sqrt(greatest(({char_js}) / 2, 0)), 4) END AS char_distance, w.js AS word_distance, a.js AS absent
  FROM d JOIN ref_chars r USING (ref) LEFT JOIN covered v USING (rid) LEFT JOIN word_js w USING (rid) LEFT JOIN absent a USING (ref)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT * EXCLUDE (rid, absent), NOT base_failed AND coalesce(char_distance, 0) <= {max_char} AND coalesce(word_distance, 0) <= {max_word} * coalesce(absent, 1) AS kept
FROM judged"""


ORACLE["op9_chat_format"] = _chat_sql()
ORACLE["op4_quality_rules"] = _rules_sql()

ORACLE["op11_phrase_collocations"] = r"""WITH docs AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (SELECT unnest(range(1, 5)) AS k))),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, n AS a FROM f WHERE k > 1 AND n >= 30),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM cand),
scores AS (SELECT cuts.lang, cuts.phrase, c, a, x.n AS l, y.n AS r,
    CAST(2000000::HUGEINT * a // (x.n::HUGEINT + y.n) AS BIGINT) AS score FROM cuts
  JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:c], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[c + 1:], ' ')),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_ AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a AS longer FROM (
  SELECT *, unnest(range(1, k - m + 2)) AS i FROM cand JOIN (SELECT unnest(range(2, 4)) AS m) ON m < k)),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100::HUGEINT * longer >= 80::HUGEINT * a)),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT p.lang, rank, phrase, a, l, r, t.n, score FROM placed p JOIN totals t USING (lang) WHERE rank <= 2000"""

ORACLE["op12_exact_topk"] = """WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
placed AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM placed WHERE rank <= 5"""

ORACLE["op13_spelling_variants"] = """WITH RECURSIVE runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
hex AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM runs WHERE length(run) >= 7),
crc AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(range(len(x) // 2),
    lambda i: [CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END)) AS h FROM hex),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM crc),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gaps AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.head || g.tail
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.head || g.tail),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN other END AS form,
  CASE WHEN most >= 10 * w.n THEN most END AS form_n FROM words w LEFT JOIN best b USING (word)),
steps AS (SELECT word, word AS last, 0 AS depth FROM forms
  UNION ALL SELECT s.word, f.form, s.depth + 1 FROM steps s JOIN forms f ON f.word = s.last WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(last, depth) AS root FROM steps GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""
