"""DuckDB SQL for the registered queries of this subpackage that SQL can express."""

from __future__ import annotations

import string

from paperwarden.llm import license_scan, mixing, quality_rules

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
SPACED = r"[^\x20\x09-\x0D]+"


def quality_rules_sql() -> str:
    lengths = sorted({quality_rules.WINDOW, *(n for n, _ in quality_rules.LIMITS)})
    leads = ", ".join(f"lead(word, {k}) OVER w AS w{k}" for k in range(1, lengths[-1]))
    windows = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS n, spot, concat_ws(' ', {', '.join(f'w{k}' for k in range(n))}) AS gram "
        f"FROM next_words WHERE w{n - 1} IS NOT NULL" for n in lengths)
    covered = ",\n".join(f"coalesce(sum(chars) FILTER (n = {n}), 0)::BIGINT AS dup_chars_{n}"
                         for n, _ in quality_rules.LIMITS)
    names = ", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n, _ in quality_rules.LIMITS)
    limits = " OR ".join(f"100 * dup_chars_{n} > {limit} * word_chars" for n, limit in quality_rules.LIMITS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS words
           FROM documents),
word AS (SELECT doc_id, unnest(range(len(words))) AS spot, unnest(words) AS word FROM d),
next_words AS (SELECT doc_id, spot, word AS w0, {leads} FROM word WINDOW w AS (PARTITION BY doc_id ORDER BY spot)),
gram AS ({windows}),
repeated AS (SELECT doc_id, n, spot FROM gram QUALIFY count(*) OVER (PARTITION BY doc_id, n, gram) > 1),
covered AS (SELECT DISTINCT doc_id, n, spot + unnest(range(n)) AS spot FROM repeated),
chars AS (SELECT doc_id, n, length(word) AS chars FROM covered JOIN word USING (doc_id, spot)),
grams AS (SELECT doc_id, count(*) FILTER (n = {quality_rules.WINDOW}) AS n_repeat_words,
                 {covered} FROM chars GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
same_line AS (SELECT doc_id, line, count(*) - 1 AS again FROM line WHERE regexp_matches(line, '{SPACED}')
              GROUP BY doc_id, line HAVING count(*) > 1),
lines AS (SELECT doc_id, sum(again)::BIGINT AS n_dup_lines,
                 sum(again * length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')))::BIGINT AS dup_line_chars
          FROM same_line GROUP BY doc_id),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(dup_line_chars, 0) AS dup_line_chars, {names}
      FROM d LEFT JOIN grams USING (doc_id) LEFT JOIN lines USING (doc_id)),
b AS (SELECT *, n_words < {quality_rules.MIN_WORDS}
             OR 100 * n_repeat_words > {quality_rules.WINDOW_LIMIT} * n_words AS base_failed FROM m)
SELECT *, NOT (base_failed OR 100 * dup_line_chars > {quality_rules.LINE_LIMIT} * word_chars OR {limits}) AS kept
FROM b"""


def license_scan_sql() -> str:
    def quoted(words):
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    rows = ",\n".join(f"('{t.label}', {t.base}, {quoted(t.words)}, {quoted(t.key.split())}, {t.key_places[0]})"
                      for t in license_scan.TEMPLATES)
    return f"""
WITH t(label, base, words, key, first) AS (VALUES {rows}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                        '{license_scan.WORD}') AS words FROM documents),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS spot FROM d),
begun AS (SELECT doc_id, t.*, spot FROM word JOIN t ON word = key[1]),
found AS (SELECT doc_id, label, base, begun.words AS template, d.words AS words, spot - first AS start
          FROM begun JOIN d USING (doc_id) WHERE d.words[spot + 1:spot + len(key)] = key),
scored AS (SELECT doc_id, label, base, start,
                  len(list_filter(range(len(template)), lambda k: start + k >= 0 AND words[start + k + 1] = template[k + 1]))
                  / len(template) AS share FROM found),
best AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
                max(start) FILTER (base) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
         FROM scored GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN best USING (doc_id)"""


def chat_examples_sql() -> str:
    def escaped(column):
        return f"replace(replace({column}, '&', '&amp;'), '<|', '&lt;|')"

    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
p AS (SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
             sum(length('<|im_start|>' || replace({escaped('role')}, chr(10), '&#10;') || chr(10) || {escaped('text')}
                        || '<|im_end|>' || chr(10))) OVER w AS chars
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT conv_id, count(*) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
             coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss,
             sum(chars) FILTER (role = 'assistant' OR place = n) AS formatted_chars,
             count(*) FILTER (role = 'assistant' OR place = n) AS n_examples
      FROM p GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars, n_examples::BIGINT AS n_examples
FROM s"""


def source_mix_sql() -> str:
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    b, n_weights = mixing.BLOCK_WORDS, len(mixing.WEIGHTS)

    def won(table, group, party, votes):
        """Seats of ``table`` (with columns _seats and votes) by highest quotients."""
        over = f"PARTITION BY {group}" if group else ""
        keys = f"{group}, {party}" if group else party
        return f"""
(WITH g AS (SELECT *, round(CASE WHEN sum({votes}) OVER ({over}) > 0 THEN {votes} * _seats / sum({votes}) OVER ({over})
                            ELSE 0.0 END)::BIGINT AS f FROM {table}),
 h AS (SELECT *, abs(sum(f) OVER ({over}) - _seats) + 1 AS off FROM g),
 i AS (SELECT *, greatest(0, f - off)::BIGINT AS sure FROM h),
 j AS (SELECT *, _seats - sum(sure) OVER ({over}) AS open FROM i),
 k AS (SELECT {keys}, open, {votes} AS votes, unnest(range(sure + 1, (f + off + 1)::BIGINT)) AS k FROM j WHERE {votes} > 0),
 l AS (SELECT {keys}, open, row_number() OVER ({over} ORDER BY votes / (2 * k - 1) DESC, {party}, k) AS place FROM k),
 w AS (SELECT {keys}, count(*) AS won FROM l WHERE place <= open GROUP BY {keys})
 SELECT j.*, sure + coalesce(won, 0) AS quota FROM j LEFT JOIN w USING ({keys}))"""

    return f"""
WITH sized AS (SELECT doc_id, source, size, md5(concat_ws(':', '{mixing.SEED}', coalesce(doc_id::VARCHAR, ''), size)) AS key
               FROM (SELECT doc_id, source,
                            len(regexp_extract_all(coalesce(text, ''), '{SPACED}'))::BIGINT AS size FROM documents)),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
limits AS (SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_no,
                  {weights}[(source_no - 1) % {n_weights} + 1]::DOUBLE AS weight,
                  (source_size * {mixing.CAP})::DOUBLE AS cap FROM totals),
levels AS (SELECT *, (sum(source_size) OVER () * ({mixing.SHARE_PERCENT} / 100)::DOUBLE
                      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_no
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY cap / weight, source_no
                                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM limits),
targets AS (SELECT source, source_no, source_size,
                   least(cap, weight * (SELECT level FROM levels WHERE level <= cap / weight
                                        ORDER BY cap / weight, source_no LIMIT 1)) AS target,
                   least({mixing.MAX_SHARDS}, greatest(1, ceil(source_size / {mixing.SHARD_WORDS})))::BIGINT AS shards
            FROM levels),
named AS (SELECT s.*, t.* EXCLUDE (source), ('0x' || substr(key, 1, 12))::BIGINT % shards AS shard,
                 ('0x' || substr(key, 13, 12))::BIGINT AS draw
          FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT source_no, shard, sum(size)::BIGINT AS shard_size,
               CASE WHEN sum(size) > 0 THEN greatest(1, round(sum(size) / {b})::BIGINT) ELSE 0 END AS blocks
        FROM named GROUP BY ALL),
voted AS (SELECT source_no, source_blocks, CASE WHEN source_size > 0 THEN target * source_blocks / source_size
                                                ELSE 0.0 END AS votes
          FROM (SELECT source_no, sum(blocks)::BIGINT AS source_blocks FROM cut GROUP BY source_no)
          JOIN targets USING (source_no)),
source_seats AS (SELECT *, round(sum(votes) OVER ())::BIGINT AS _seats FROM voted),
source_quota AS (SELECT source_no, least(quota, source_blocks * {mixing.CAP})::BIGINT AS _seats
                 FROM {won('source_seats', '', 'source_no', 'votes')}),
shard_seats AS (SELECT * FROM cut JOIN source_quota USING (source_no)),
quotas AS (SELECT source_no, shard, shard_size, blocks, least(quota, blocks * {mixing.CAP})::BIGINT AS quota
           FROM {won('shard_seats', 'source_no', 'shard', 'blocks')}),
placed AS (SELECT *, sum(size) OVER (PARTITION BY source_no, shard ORDER BY draw, doc_id, size
                                     ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM named),
q AS (SELECT *, stop - size AS start, shard_size AS n, (source_no * 1000003 + shard * 7919) % greatest(blocks, 1) AS turn
      FROM placed JOIN quotas USING (source_no, shard))
SELECT doc_id, source, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
       quota // blocks * size + list_sum([
           CASE WHEN (j::HUGEINT * {mixing.PRIME} + turn) % blocks < quota % blocks
                THEN least((j + 1) * n // blocks, stop) - greatest(j * n // blocks, start) ELSE 0 END
           FOR j IN range(((start + 1) * blocks + n - 1) // n - 1, (stop * blocks + n - 1) // n)]) END::BIGINT AS taken
FROM q"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a short ASCII text."""
    table = ("list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: "
             "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END))")
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: "
            f"xor(a >> 8, ({table})[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)")


def conversation_trie_sql() -> str:
    return f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS family, {crc32_sql('conv_id::VARCHAR')} % 9 AS h, count(*) AS n
      FROM t GROUP BY conv_id),
k AS (SELECT c.*, least(c.h, coalesce(f.n, 0)) AS taken FROM c LEFT JOIN c f ON f.conv_id = c.family),
r AS (SELECT conv_id, p - h + taken + 1 AS depth, role, text FROM t JOIN k USING (conv_id) WHERE p >= h
      UNION ALL SELECT k.conv_id, p + 1, role, text FROM k JOIN t ON t.conv_id = k.family WHERE p < taken),
cut AS (SELECT conv_id, depth, strlen(text) AS bytes, md5(string_agg(md5(strlen(role) || ':' || role || text), '') OVER (
               PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS node FROM r
        UNION ALL SELECT conv_id, 0, 0, '' FROM c),
nodes AS (SELECT depth, node, count(*) AS n_convs, min(conv_id) AS conv_id, max(bytes) AS bytes FROM cut GROUP BY ALL),
ends AS (SELECT depth, node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM cut
         WHERE (conv_id, depth) IN (SELECT (conv_id, max(depth)) FROM cut GROUP BY conv_id) GROUP BY ALL),
up AS (SELECT DISTINCT a.depth, a.node, b.node AS parent FROM cut a JOIN cut b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1),
born AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM up GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN born USING (depth, node)),
below AS (SELECT a.depth, a.node, count(*) FILTER (y.n_children = 0) AS n_leaves, sum((y.n_convs - 1) * y.bytes) AS saved_tokens
          FROM full_nodes y JOIN cut a ON a.conv_id = y.conv_id AND a.depth <= y.depth GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM full_nodes n JOIN below USING (depth, node) LEFT JOIN ends USING (depth, node) LEFT JOIN up USING (depth, node)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = up.parent"""


def merkle_manifest_sql(depth: int = 7) -> str:
    """Trees of at most 8 to the power ``depth`` leaves, level by level."""
    def digest(text):
        told = ", ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
                         for c in ("doc_id", "source", "lang", "n_chars", text))
        return f"sha256(concat({told}))"

    def climb(name):
        return "".join(f"""
{name}{k} AS (SELECT tree, pos // 8 AS pos, CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h,
                     (n + 7) // 8 AS n FROM {name}{k - 1} GROUP BY tree, pos // 8, n),
{name}_side{k - 1} AS (SELECT a.tree, a.pos, a.n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
                     coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
              FROM {name}{k - 1} a JOIN {name}{k - 1} b ON a.tree = b.tree AND a.pos // 8 = b.pos // 8
              GROUP BY a.tree, a.pos, a.n),""" for k in range(1, depth + 1))

    def steps(before, name, pos):
        return "".join(f"""
{name}_step{k} AS (SELECT p.* EXCLUDE (f, proof), CASE WHEN s.n = 1 THEN f ELSE sha256(l || f || r) END AS f,
                          CASE WHEN s.n = 1 THEN proof ELSE proof || l || r END AS proof
                   FROM {before if k == 0 else f'{name}_step{k - 1}'} p
                   JOIN {name}_side{k} s ON s.tree = {'p.tree' if name == 'low' else '0'} AND s.pos = p.{pos} // {8 ** k}),"""
                       for k in range(depth))

    small = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""
WITH d AS (SELECT doc_id, lang, {digest('text')} AS leaf,
                  CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN {digest(small)} ELSE {digest('text')} END AS claimed
           FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY lang) AS n FROM d),
low0 AS (SELECT tree, pos, leaf AS h, n FROM placed),{climb('low')}
top0 AS (SELECT 0 AS tree, tree AS pos, h, count(*) OVER () AS n FROM low{depth}),{climb('top')}
begun AS (SELECT doc_id, leaf, tree, pos, claimed AS f, '' AS proof FROM placed),{steps('begun', 'low', 'pos')}
{steps(f'low_step{depth - 1}', 'top', 'tree')}
root AS (SELECT h AS root FROM top{depth})
SELECT doc_id, leaf, low{depth}.h AS subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM top_step{depth - 1} p JOIN low{depth} ON low{depth}.tree = p.tree, root"""


def oracle_sql() -> dict[str, str]:
    return {"op4_license_scan": license_scan_sql(), "op6_chat_examples": chat_examples_sql(),
            "op9_quality_rules": quality_rules_sql(), "op10_source_mix": source_mix_sql(),
            "op11_conversation_trie": conversation_trie_sql(), "op13_merkle_manifest": merkle_manifest_sql()}
