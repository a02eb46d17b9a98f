"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_TRIM = "trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_KEY = f"translate({_TRIM}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format("line")

ORACLE["op1_line_dedup"] = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM parts),
keyed AS (SELECT doc_id, pos, line, {_KEY} AS k FROM lines),
shared AS (
    SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10
    GROUP BY k HAVING count(DISTINCT doc_id) >= 2
),
marked AS (
    SELECT keyed.*, (shared.k IS NOT NULL AND keyed.doc_id <> shared.first_doc) AS gone
    FROM keyed LEFT JOIN shared ON keyed.k = shared.k
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Threshold places come from the running sum in hash order; the operator finds the same places by histograms.
ORACLE["op3_mix_sources"] = r"""
WITH sized AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5(doc_id::VARCHAR), 1, 9))::BIGINT AS u
    FROM documents
),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
    SELECT *, (ARRAY[5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
        2 * source_size::DOUBLE AS cap
    FROM totals
),
levels AS (
    SELECT *, row_number() OVER o AS place,
        (sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
    FROM weighted WINDOW o AS (ORDER BY cap / w, source NULLS LAST)
),
final AS (SELECT arg_min(lv, place) AS lv FROM levels WHERE cap > w * lv),
targets AS (
    SELECT source, source_size, coalesce(least(cap, w * final.lv), cap) AS target,
        CASE WHEN source_size > 0 THEN floor(coalesce(least(cap, w * final.lv), cap) / source_size)::BIGINT
            ELSE 0 END AS whole
    FROM levels, final
),
hashes AS (SELECT source, u, sum(size) AS s FROM sized GROUP BY source, u),
running AS (
    SELECT hashes.source, u, sum(s) OVER (PARTITION BY hashes.source ORDER BY u) AS upto, s,
        target - whole * source_size AS rest
    FROM hashes JOIN targets ON hashes.source IS NOT DISTINCT FROM targets.source
),
edge AS (
    SELECT source, CASE WHEN upto - rest < rest - (upto - s) THEN u ELSE u - 1 END AS last
    FROM running WHERE upto - s < rest AND upto >= rest
)
SELECT doc_id, size, source_size, target,
    (size * (whole + CASE WHEN u <= coalesce(last, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
LEFT JOIN edge ON sized.source IS NOT DISTINCT FROM edge.source
"""

ORACLE["op7_quality_rules"] = r"""
WITH split AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words,
        coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0)::BIGINT AS n_symbols,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM documents
),
counts AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines
    FROM split
),
windows AS (
    SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
),
twice AS (SELECT doc_id, a, b, c FROM windows GROUP BY ALL HAVING count(*) > 1),
inside AS (
    SELECT DISTINCT doc_id, i + k AS word
    FROM windows JOIN twice USING (doc_id, a, b, c), (VALUES (0), (1), (2)) AS step(k)
),
repeats AS (SELECT doc_id, count(*)::BIGINT AS n_repeat_words FROM inside GROUP BY doc_id),
metrics AS (
    SELECT counts.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM counts LEFT JOIN repeats USING (doc_id)
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM metrics)
SELECT *, NOT (base_failed OR 2 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_dup_lines > 3 * n_words) AS kept
FROM judged
"""

# Unsigned CRC-32 of a decimal number, bit by bit: a byte is mixed in, then eight shifts (-1) follow.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(
    list_concat([4294967295::BIGINT], flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
        for c in string_split({0}::VARCHAR, '')])),
    lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384::BIGINT * (s & 1)) END))"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _climb(step: str, below: str, tree: str) -> str:
    """One level of all trees: the own node and its run with the others, then the run's digest."""
    return f"""
{step} AS (
    SELECT {tree}, pos // 16 AS pos, CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END
        AS digest, any_value((n + 15) // 16) AS n
    FROM {below} GROUP BY {tree}, pos // 16, n
)"""


_TREE_LEVELS = 6  # 16 ** 6 leaves a tree; lone nodes stay as they are, so more levels change nothing
_ROOT_LEVELS = 3


def _merkle_sql() -> str:
    parts = [
        f"""leaves AS (
    SELECT doc_id, source, {_leaf('text')} AS leaf,
        CASE WHEN ({_CRC32.format('doc_id')}) % 5 = 0
            THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS claimed
    FROM documents
)""",
        """t0 AS (
    SELECT *, leaf AS digest, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS n
    FROM leaves
)""",
    ]
    parts += [_climb(f"t{i + 1}", f"t{i}", "source").strip() for i in range(_TREE_LEVELS)]
    parts.append(
        f"""u0 AS (
    SELECT source, digest, 0 AS tree, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM t{_TREE_LEVELS}
)"""
    )
    parts += [_climb(f"u{i + 1}", f"u{i}", "tree").strip() for i in range(_ROOT_LEVELS)]
    # Each level adds a run's digests before and behind the own node, and folds them.
    parts.append("w0 AS (SELECT doc_id, source, leaf, pos AS place, '' AS proof, coalesce(claimed, leaf) AS folded FROM t0)")
    step = 0
    for kind, levels, tree in (("t", _TREE_LEVELS, "source"), ("u", _ROOT_LEVELS, "tree")):
        for level in range(levels):
            if kind == "u" and level == 0:
                parts.append(
                    f"""w{step + 1} AS (
    SELECT w.doc_id, w.source, w.leaf, u0.pos AS place, w.proof, w.folded, u0.tree, u0.digest AS subroot
    FROM w{step} w JOIN u0 ON w.source IS NOT DISTINCT FROM u0.source
)"""
                )
                step += 1
            more = ", tree, subroot" if kind == "u" else ""
            parts.append(
                f"""w{step + 1} AS (
    SELECT doc_id, source, leaf, place // 16 AS place, proof || before || behind AS proof,
        CASE WHEN several THEN sha256(before || folded || behind) ELSE folded END AS folded{more}
    FROM (
        SELECT w.*, m.n > 1 AS several,
            array_to_string(m.digests[:w.place % 16], '') AS before, array_to_string(m.digests[w.place % 16 + 2:], '') AS behind
        FROM w{step} w JOIN (
            SELECT {tree}, pos // 16 AS run, n, list(digest ORDER BY pos) AS digests FROM {kind}{level} GROUP BY {tree}, pos // 16, n
        ) m ON w.{tree} IS NOT DISTINCT FROM m.{tree} AND w.place // 16 = m.run
    )
)"""
            )
            step += 1
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM w{step}, u{_ROOT_LEVELS}
"""
    )


ORACLE["op11_merkle_manifest"] = _merkle_sql()

# Neighbouring starts of equal words a period apart make a stretch; of stretches at one place the least period counts.
ORACLE["op13_periodic_runs"] = rf"""
WITH split AS (
    SELECT doc_id, {_CRC32.format('doc_id')} AS h, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws
    FROM documents
),
planned AS (SELECT *, len(ws) AS n, h // 10 AS g, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM split),
texts AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN [ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] for i in range(n)]
        ELSE ws END AS ws
    FROM planned
),
words AS (SELECT doc_id, n, unnest(ws) AS w, unnest(range(n)) AS i FROM texts),
coded AS (SELECT doc_id, n, i, dense_rank() OVER (ORDER BY w) AS w FROM words),
pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q
    FROM coded x JOIN coded y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND y.i - x.i <= x.n // 4
),
stretches AS (
    SELECT doc_id, q, min(i) AS s, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
    GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
),
runs AS (SELECT doc_id, s, length, min(q) AS q FROM stretches GROUP BY doc_id, s, length),
listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS runs
    FROM runs GROUP BY doc_id
),
best AS (
    SELECT DISTINCT ON (doc_id) doc_id, s, length, q FROM runs
    ORDER BY doc_id, length::DECIMAL(18, 0) * 1000000000000 // q DESC, s, q
),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs),
kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT texts.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, best.length::BIGINT AS length, q::BIGINT AS period,
    (1000 * best.length // q)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
    sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
