"""SQL counterparts (DuckDB) of the queries that SQL can express."""

SPACES = "'[\\x20\\x09-\\x0D]+'"

#: Names of the rules, their figures, least spreads, spreads and side, as in quality_rules.RULES.
_FIGURES = """
  SELECT *, 1000 * n_symbols // greatest(word_chars, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
    1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 1000 * n_stutter // greatest(n_words, 1) AS stutter, 1000 * n_capitals // greatest(word_chars, 1) AS capitals,
    100 * word_chars // greatest(n_words, 1) AS word_length, 100 * word_chars // greatest(n_words, 1) AS short_words
  FROM counted"""
#: The 12 leading bits of a figure.
_BIN = "((fig >> greatest(length(bin(fig)) - 12, 0)) << greatest(length(bin(fig)) - 12, 0))"

OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, [x FOR x IN regexp_split_to_array(text, {SPACES}) IF x <> ''] AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM d),
windows AS (SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS win FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
cover AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range(8) AS t(k) GROUP BY rid),
counted AS (SELECT w.rid, doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, length(regexp_replace(text, '\\P{{Lu}}+', '', 'g'))::BIGINT AS n_capitals,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
    len([1 FOR x, i IN words IF i > 1 AND words[i - 1] = x])::BIGINT AS n_stutter
  FROM w LEFT JOIN cover USING (rid)),
figures AS ({_FIGURES}),
long AS (UNPIVOT figures ON symbols, dup_lines, repeats, stutter, capitals, word_length, short_words INTO NAME rule VALUE fig),
params(rule, least_spread, spreads, side) AS (VALUES ('symbols', 20, 3, 1), ('dup_lines', 150, 3, 1), ('repeats', 90, 3, 1), ('stutter', 70, 3, 1), ('capitals', 40, 3, 1), ('word_length', 60, 5, 1), ('short_words', 60, 5, -1)),
own AS (SELECT lang, source, rule, count(*) AS n, quantile_disc({_BIN}, 0.25) AS q1, quantile_disc({_BIN}, 0.75) AS q3 FROM long GROUP BY ALL),
wide AS (SELECT lang, rule, quantile_disc({_BIN}, 0.25) AS q1, quantile_disc({_BIN}, 0.75) AS q3 FROM long GROUP BY ALL),
bounds AS (SELECT own.lang, own.source, rule, side, floor((own.n * (if(side = 1, own.q3, own.q1) + side * spreads * greatest(own.q3 - own.q1, least_spread))
    + 50 * (if(side = 1, wide.q3, wide.q1) + side * spreads * greatest(wide.q3 - wide.q1, least_spread))) / (own.n + 50)) AS bound
  FROM own JOIN wide USING (lang, rule) JOIN params USING (rule)),
broken AS (SELECT rid, bool_or(if(side = 1, fig > bound, fig < bound)) AS broken FROM long JOIN bounds USING (lang, source, rule) GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT broken AS kept
FROM counted JOIN broken USING (rid)"""

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
keyed AS (SELECT *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT rid, keyed.doc_id, line, i, keeper IS NOT NULL AND keyed.doc_id <> keeper AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id"""

OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, row_number() OVER () AS rid FROM pages),
r AS (SELECT *, page_id IS NOT NULL AND strlen(h) >= 100 AND row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST, rid) > 1 AS again, min(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest, if(again, 'revisit', 'response') AS record_type, if(again, head, NULL) AS refers_to FROM r"""


def _merkle() -> str:
    """Levels written out one by one: 8 for the leaves of a language (8 to the 8th power), 4 for the languages."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = "SELECT i, i AS c FROM range(256) AS t(i)"
    for _ in range(8):  # the table of the checksum, by its rule
        crc = f"SELECT i, if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1) AS c FROM ({crc})"
    parts = [
        f"crc AS (SELECT list(c ORDER BY i) AS t FROM ({crc}))",
        f"""d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf("text")} AS leaf, {leaf(lower)} AS lowered,
          xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS checksum FROM documents, crc)""",
        "a0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)",
        "n0 AS (SELECT tree, pos, leaf AS h FROM a0)",
    ]

    def level(name: str, k: int) -> None:
        run = f"PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
        parts.append(f"""{name}s{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) > 1 AS going, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
          coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
        parts.append(f"{name}{k + 1} AS (SELECT tree, pos // 8 AS pos, if(bool_or(going), sha256(string_agg(h, '' ORDER BY pos)), min(h)) AS h FROM {name}s{k} GROUP BY tree, pos // 8)")

    for k in range(8):
        level("n", k)
    parts.append("t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, tree AS name FROM n8)")
    for k in range(4):
        level("t", k)
    parts.append("p0 AS (SELECT a0.*, if(checksum % 3 = 0, lowered, leaf) AS f, '' AS proof, t0.pos AS place, t0.h AS subroot, t4.h AS root FROM a0 JOIN t0 ON t0.name = a0.tree, t4)")
    for k in range(12):
        join = f"ns{k} AS s ON s.tree = p.tree AND s.pos = p.pos // {8**k}" if k < 8 else f"ts{k - 8} AS s ON s.pos = p.place // {8**(k - 8)}"
        parts.append(f"p{k + 1} AS (SELECT p.* REPLACE (if(s.going, sha256(s.l || p.f || s.r), p.f) AS f, if(s.going, p.proof || s.l || s.r, p.proof) AS proof) FROM p{k} AS p JOIN {join})")
    return "WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM p12"


OP11 = _merkle()
