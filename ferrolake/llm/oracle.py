"""DuckDB SQL that gives the rows of the operators that SQL can express.

The SQL restates each contract directly (no Bloom filter, no candidate search,
no levels), so it checks the operators' results, not their steps.
"""

from __future__ import annotations

from .audit import ORDERS
from .licenses import NOTICES, PHRASES, SHARE, SLACK, template_words
from .urls import INSULTS, RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def ascii_lower(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"


def urls_sql() -> str:
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(v, h + p, f"(host = {q(h)} OR ends_with(host, {q('.' + h)})) AND starts_with(path, {q(p)})")
            for v, h, p in longest]
    rule = " ".join(f"WHEN {c} THEN {q(r)}" for _, r, c in fits)
    verdict = " ".join(f"WHEN {c} THEN {q(v)}" for v, _, c in fits)
    return f"""WITH parts AS (SELECT page_id, html, CASE WHEN contains(url, '://')
      THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (SELECT page_id, html, {ascii_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
    named AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '')
      || regexp_replace(path, '/$', '') END AS canonical FROM split),
    listed AS (SELECT DISTINCT canonical FROM named WHERE canonical IS NOT NULL
      AND regexp_matches(html, '\\b({'|'.join(INSULTS)})\\b'))
    SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict}
      WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
    FROM named n LEFT JOIN listed l ON l.canonical = n.canonical"""


def chat_sql() -> str:
    own = q("</s>[INST] ok [/INST]")
    esc = lambda x: ("replace(replace(replace(replace(" + x + r", '\', '\b'), '<', '\l'), "  # noqa: E731
                     r"'[', '\s'), ']', '\c')")
    by = "ORDER BY turn, role, text"
    return f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role,
      coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', {own} UNION ALL SELECT -7, 1, 'assistant', {own}),
    near AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM turns
      WINDOW w AS (PARTITION BY conv_id {by})),
    pieces AS (SELECT *, CASE WHEN before = role THEN '<sep>' ELSE '<s>[' || {esc('role')} || ']' END
      || {esc('text')} || CASE WHEN after = role THEN '' ELSE '</s>' END AS piece FROM near),
    convs AS (SELECT conv_id, count(*) AS n_turns,
      string_agg(role || chr(10) || text || chr(10), '' {by}) AS said,
      coalesce(string_agg(text, '' {by}) FILTER (WHERE role = 'assistant'), '') AS loss,
      string_agg(piece, '' {by}) AS formatted FROM pieces GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
      sha256(loss) AS loss_sha256, length(formatted) AS formatted_chars FROM convs"""


def licenses_sql() -> str:
    rows = []
    for base, items in ((True, PHRASES), (False, NOTICES)):
        for i, (label, text) in enumerate(items):
            w = template_words(text)
            k = 2 if base else 3
            n = len(w) - k + 1
            rows += [f"({q(f'{base}{i}')}, {str(base).lower()}, {q(label)}, {j}, {n}, {len(w)}, "
                     f"{q(' '.join(w[j:j + k]))}, {k})" for j in range(n)]
    text = ascii_lower("coalesce(text, '')")
    split = rf"string_split_regex({text}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    labels = "coalesce(string_agg(DISTINCT {0}, ',' ORDER BY {0}), '')"
    return f"""WITH docs AS (SELECT doc_id, list_filter({split}, lambda x: x <> '') AS w FROM documents),
    tpl(tpl, base, label, tpos, grams, words, gram, k) AS (VALUES {', '.join(rows)}),
    each AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
    grams AS (SELECT doc_id, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS g2,
      w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g3, len(w) AS n, i FROM each WHERE i < len(w)),
    hits AS (SELECT g.doc_id, t.*, pos - tpos AS diagonal, pos FROM grams g JOIN tpl t
      ON t.gram = CASE WHEN t.k = 2 THEN g.g2 WHEN g.i + 1 < g.n THEN g.g3 END),
    votes AS (SELECT doc_id, tpl, base, label, grams, words, diagonal, count(*) AS votes
      FROM hits GROUP BY ALL),
    merged AS (SELECT v.*, count(DISTINCT h.tpos) AS seen, min(h.pos) AS a, max(h.pos) AS z
      FROM votes v JOIN hits h ON h.doc_id = v.doc_id AND h.tpl = v.tpl
        AND h.diagonal BETWEEN v.diagonal AND v.diagonal + {SLACK} GROUP BY ALL),
    found AS (SELECT doc_id, label, diagonal, base AND votes = grams AS place,
      NOT base AND z - a + 3 <= words + {SLACK} AS fits,
      seen::DOUBLE / grams AS share FROM merged),
    per AS (SELECT doc_id, count(*) FILTER (WHERE place) AS n_base,
      min(diagonal) FILTER (WHERE place) AS first_word, max(diagonal) FILTER (WHERE place) AS last_word,
      {labels.format("CASE WHEN place THEN label END")} AS base_labels,
      {labels.format(f"CASE WHEN place OR (fits AND share >= {SHARE}) THEN label END")} AS labels,
      max(CASE WHEN place THEN 1.0::DOUBLE WHEN fits THEN share END) AS score
      FROM found GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
      coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
      coalesce(score, 0.0::DOUBLE) AS score FROM docs d LEFT JOIN per USING (doc_id)"""


SPLIT_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def substrings_sql(window: int = 50) -> str:
    words = SPLIT_WORDS.format("coalesce(text, '')")
    return f"""WITH docs AS (SELECT doc_id, {words} AS w FROM documents),
    starts AS (SELECT doc_id, w, unnest(range(1, len(w) - {window} + 2)) AS i FROM docs
      WHERE len(w) >= {window}),
    windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {window} - 1], ' ')) AS h FROM starts),
    least AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS pos FROM windows
      JOIN least USING (h) WHERE doc_id > first),
    each AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM docs),
    kept AS (SELECT e.doc_id, string_agg(w[pos], ' ' ORDER BY pos) AS kept, count(*) AS n FROM each e
      ANTI JOIN gone USING (doc_id, pos) GROUP BY e.doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(k.n, 0) AS n_removed,
      sha256(coalesce(kept, '')) AS kept_sha256 FROM docs d LEFT JOIN kept k USING (doc_id)"""


def jaccard_sql(words: int = 5, num: int = 75, den: int = 100) -> str:
    split = SPLIT_WORDS.format(ascii_lower("coalesce(text, '')"))
    return f"""WITH RECURSIVE docs AS (SELECT doc_id, {split} AS w FROM documents),
    starts AS (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {words - 1}) + 1)) AS i
      FROM docs WHERE len(w) > 0),
    grams AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + {words - 1}], ' ')) AS g FROM starts),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b
      ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE {den} * c.n >= {num} * (x.n + y.n - c.n)),
    sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(doc_id, root) AS (SELECT a, a FROM sides UNION SELECT b, root FROM reach JOIN sides ON a = doc_id),
    least AS (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id
    FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""


def audit_sql() -> str:
    words = SPLIT_WORDS.format("text")
    fails = {"A": "len(w) < 100", "B": "100 * len(list_distinct(w)) < 80 * len(w)",
             "C": "100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text)",
             "D": "regexp_matches(text, '[#$%&*|]')", "E": "coalesce(doc_id > first, false)"}
    orders = ", ".join(f"({q(o)})" for o in ORDERS)
    steps = " UNION ALL ".join(
        f"SELECT filter_order, {k} AS step, substr(filter_order, {k}, 1) AS letter, "
        f"substr(filter_order, 1, {k - 1}) AS before FROM orders" for k in range(1, 6))
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part
      FROM documents),
    firsts AS (SELECT *, {words} AS w, min(doc_id) OVER (PARTITION BY text) AS first FROM docs),
    flags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
      max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
    judged AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
      {' || '.join(f"CASE WHEN {c} THEN {q(f)} ELSE '' END" for f, c in fails.items())} AS failed
      FROM firsts LEFT JOIN flags USING (doc_id)),
    counts AS (SELECT part, failed, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
    orders(filter_order) AS (VALUES {orders}),
    steps AS ({steps}),
    rows AS (SELECT part, filter_order, step, letter, n, good, toxic, failed,
      contains(failed, letter) AS fails, before <> '' AND regexp_matches(failed,
        '[' || CASE before WHEN '' THEN '-' ELSE before END || ']') AS gone FROM counts, steps),
    sums AS (SELECT part, filter_order, step, letter,
      sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
      sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
      sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
      sum(CASE WHEN failed = letter THEN n ELSE 0 END) AS unique_fails,
      sum(CASE WHEN fails AND NOT gone AND good = 1 THEN n ELSE 0 END) AS good_lost,
      sum(CASE WHEN fails AND NOT gone AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
      FROM rows GROUP BY part, filter_order, step, letter)
    SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
      redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
      good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
      (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM sums"""


def minhash_sql() -> str:
    return f"SELECT *, doc_id = component_id AS kept FROM ({jaccard_sql(2, 80, 100)})"
