"""The queries that SQL can express, as DuckDB reads them."""

from __future__ import annotations

from goldenlake.llm.licenses import BASE_PHRASES, NOTICES, THRESHOLD, UPPER, block_step, needed, notice_words

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _places(phrase: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(words))
    return f"list_filter(range(greatest(len(words) - {len(words) - 1}, 0)), lambda i: {same})"


def _best(notice: str) -> str:
    """Containment of a notice in the best block; 0 below the threshold."""
    words, step = notice_words(notice), block_step(NOTICES)
    common = f"len(list_intersect({words!r}, words[i + 1 : i + {2 * step}]))"
    best = f"list_max(list_transform(range(0, greatest(len(words), 1), {step}), lambda i: {common}))"
    return f"CASE WHEN {best} >= {needed(len(words), THRESHOLD)} THEN {best} / {len(words)}.0::DOUBLE ELSE 0 END"


def _license_scan() -> str:
    base = list(BASE_PHRASES.items())
    names = list(NOTICES)
    starts = "list_concat(" * (len(base) - 1) + "at_0" + "".join(f", at_{i})" for i in range(1, len(base)))
    base_labels = "[" + ", ".join(f"CASE WHEN len(at_{i}) > 0 THEN '{label}' END" for i, (_, label) in enumerate(base)) + "]"
    found = "[" + ", ".join(f"CASE WHEN t_{i} > 0 THEN '{name}' END" for i, name in enumerate(names)) + "]"
    joined = "array_to_string(list_sort(list_distinct(list_filter({0}, lambda x: x IS NOT NULL))), ',')"
    return f"""
        WITH a AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS low FROM documents),
        b AS (SELECT *, regexp_extract_all(low, {_WORDS}) AS words FROM a),
        c AS (SELECT *, {", ".join(f"{_places(p)} AS at_{i}" for i, (p, _) in enumerate(base))},
                     {", ".join(f"{_best(NOTICES[n])} AS t_{i}" for i, n in enumerate(names))} FROM b),
        d AS (SELECT *, {starts} AS starts FROM c)
        SELECT doc_id, len(words)::BIGINT AS n_words, len(starts)::BIGINT AS n_base,
               list_min(starts)::BIGINT AS first_word, list_max(starts)::BIGINT AS last_word,
               {joined.format(base_labels)} AS base_labels,
               {joined.format(f"list_concat({base_labels}, {found})")} AS labels,
               CASE WHEN len(starts) > 0 THEN 1.0::DOUBLE
                    ELSE greatest({", ".join(f"t_{i}" for i in range(len(names)))})::DOUBLE END AS score
        FROM d"""


STATEMENTS: dict[str, str] = {"op2_license_scan": _license_scan()}
