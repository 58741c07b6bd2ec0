"""SQL twins of the text operators that SQL can express, for DuckDB over the same tables."""

from souk.llm import decontaminate, quality, queries

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _named(column: str, weights: dict[str, int]) -> str:
    cases = " ".join(f"WHEN {column} = '{name}' THEN {value}" for name, value in weights.items())
    return f"CASE {cases} ELSE 1 END" if cases else "1"


def _share(level: str, keys: list[str], weights: dict[str, int], above: str | None) -> str:
    """The budget of each parent shared among its children, as in :func:`souk.llm.mixing.share`."""
    parents = keys[:-1]
    family = f"PARTITION BY {', '.join(parents)}" if parents else ""
    ranked = f"{family} ORDER BY cap / nullif(weight, 0)::DOUBLE NULLS LAST, {keys[-1]} NULLS FIRST"
    match = " AND ".join(f"n.{k} IS NOT DISTINCT FROM up.{k}" for k in parents)
    budget = f"JOIN {above} up ON {match}" if above else "CROSS JOIN total up"
    given = "up.given" if above else "up.budget"
    names = ", ".join(keys)
    return f"""
    {level}0 AS (SELECT {', '.join(f'n.{k}' for k in keys)}, n.cap, {_named(f'n.{keys[-1]}', weights)} AS weight, {given} AS budget
        FROM (SELECT {names}, sum(tokens * {queries.MAX_EPOCHS})::BIGINT AS cap FROM leaves GROUP BY {names}) n {budget}),
    {level}1 AS (SELECT *, coalesce(sum(cap) OVER ({ranked} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(weight) OVER ({ranked} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM {level}0),
    {level}2 AS (SELECT *, weight > 0 AND cap::DOUBLE * rest <= (budget - before)::DOUBLE * weight AS is_full FROM {level}1),
    {level}3 AS (SELECT *, budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({family}) AS left_over,
        sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family}) AS open FROM {level}2),
    {level} AS (SELECT {names}, CASE WHEN is_full THEN cap
        WHEN open > 0 THEN least(cap, floor(left_over::DOUBLE * weight / open)::BIGINT) ELSE 0 END AS given FROM {level}3)"""


def source_mix() -> str:
    domains = " ".join(f"WHEN source IN ({', '.join(repr(s) for s in names)}) THEN '{d}'" for d, names in queries.DOMAINS.items())
    same = lambda a, b: " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in ("domain", "lang", "source"))
    w = queries.WEIGHTS
    return f"""
    WITH light AS (SELECT doc_id, CASE {domains} ELSE '{queries.OTHER_DOMAIN}' END AS domain, lang, source, len({WORDS}) AS n FROM documents),
    leaves AS (SELECT domain, lang, source, sum(n)::BIGINT AS tokens FROM light GROUP BY ALL),
    total AS (SELECT floor(coalesce(sum(tokens), 0) * {float(queries.BUDGET)})::BIGINT AS budget FROM leaves),
    {_share("ds", ["domain"], w[0], None)}, {_share("ls", ["domain", "lang"], w[1], "ds")},
    {_share("ss", ["domain", "lang", "source"], w[2], "ls")},
    plan AS (SELECT a.domain, a.lang, a.source, tokens, given, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS passes
        FROM leaves a JOIN ss ON {same("a", "ss")}),
    keyed AS (SELECT light.*, given, passes, given - passes * tokens AS rest,
        md5(concat_ws(':', '{queries.SEED}', (passes + 1)::VARCHAR, doc_id::VARCHAR)) AS k FROM light JOIN plan ON {same("light", "plan")}),
    running AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY k, n
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed),
    cuts AS (SELECT *, max(CASE WHEN before < rest THEN k END) OVER (PARTITION BY domain, lang, source) AS cut FROM running)
    SELECT doc_id, domain, lang, source, given AS leaf_given,
        (passes + CASE WHEN coalesce(k <= cut, false) THEN 1 ELSE 0 END)::INTEGER AS epochs FROM cuts"""


def _template(table: str, key: str) -> str:
    d = decontaminate
    capitals, number = (p.replace("*+", "*") for p in (d.CAPITALS, d.NUMBER))  # DuckDB's matcher never recurs
    named = rf"regexp_replace(coalesce(text, ''), '{capitals}', '\1 {d.NAME}\2{d.END} ', 'g')"
    typed = rf"lower(regexp_replace({named}, '{number}', ' {d.NUM}\1{d.END} {d.UNIT}\2{d.END} ', 'g'))"
    return f"SELECT {key}, regexp_extract_all({typed}, '{d.TOKEN}') AS v FROM (SELECT DISTINCT {key}, text FROM {table})"


def template_leaks() -> str:
    """Windows as text instead of hashes; for questions of at least a window's length."""
    d, n = decontaminate, decontaminate.WINDOW
    marks = f"{d.NUM}{d.UNIT}{d.NAME}"
    kind = f"list_transform(v, lambda x: CASE WHEN contains('{marks}', x[1]) THEN x[1] ELSE x END)"
    window = f"array_to_string(list_slice(k, p, p + {n - 1}), ' ')"
    windows = lambda t, key: f"SELECT {key}, p, {window} AS w FROM (SELECT {key}, k, unnest(range(1, len(k) - {n - 2})) AS p FROM {t})"
    return f"""
    WITH qv AS ({_template("benchmark", "item_id")}), dv AS ({_template("documents", "doc_id")}),
    q AS (SELECT *, {kind} AS k FROM qv), d AS (SELECT *, {kind} AS k FROM dv),
    qw AS ({windows("q", "item_id")}), dw AS ({windows("d", "doc_id")}),
    hits AS (SELECT doc_id, item_id, dw.p - qw.p AS shift, qw.p AS j FROM dw JOIN qw USING (w)),
    lines AS (SELECT doc_id, item_id, shift, list_distinct(list(j)) AS js FROM hits GROUP BY ALL),
    spots AS (SELECT DISTINCT doc_id, item_id, shift, unnest(js) + o AS pos FROM lines, range({n}) r(o)),
    slots AS (SELECT DISTINCT doc_id, item_id, shift, q.v[pos] AS qs, d.v[pos + shift] AS ds
        FROM spots JOIN q USING (item_id) JOIN d USING (doc_id) WHERE contains('{marks}', q.v[pos][1])),
    sums AS (SELECT doc_id, item_id, shift, count(*) AS n_pairs, count(DISTINCT qs) AS n_slots, bool_or(qs <> ds) AS changed
        FROM slots GROUP BY ALL),
    sound AS (SELECT doc_id, item_id, unnest(js) AS j, coalesce(n_slots, 0) AS n_slots, coalesce(changed, false) AS changed
        FROM lines LEFT JOIN sums USING (doc_id, item_id, shift) WHERE n_pairs IS NULL OR n_pairs = n_slots)
    SELECT doc_id, item_id, any_value(len(k) - {n - 1})::INTEGER AS n_windows, count(DISTINCT j) AS n_matched,
        max(n_slots)::INTEGER AS n_slots, bool_or(changed) AS changed
    FROM sound JOIN q USING (item_id) GROUP BY doc_id, item_id
    HAVING count(DISTINCT j) >= any_value(len(k) - {n - 1}) * {d.MIN_CONTAINED}"""


def quality_outliers() -> str:
    q = quality
    p, pairs = range(q.P), q.PAIRS
    on = lambda a, b: f"{a}.lang IS NOT DISTINCT FROM {b}.lang AND {a}.source IS NOT DISTINCT FROM {b}.source"
    floor2 = [(q.FLOORS[i] * q.SCALE) * (q.FLOORS[i] * q.SCALE) for i in p]
    x = ", ".join(f"x{i}" for i in p)

    def root(name: str, estimate: str) -> list[str]:
        out, last = [], estimate
        for i, j in pairs:
            rest = f"c{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            out.append(f"{name}_{i}{j} AS (SELECT *, {f'sqrt({rest})' if i == j else f'({rest}) / l{j}{j}'} AS l{i}{j} FROM {last})")
            last = f"{name}_{i}{j}"
        shown = ", ".join([f"m{i}" for i in p] + [f"l{i}{j}" for i, j in pairs])
        out.append(f"{name}_z AS (SELECT r.*, {shown} FROM passed r JOIN {last} e ON {on('r', 'e')})")
        last = f"{name}_z"
        for i in p:
            rest = f"x{i} - m{i}" + "".join(f" - l{i}{k} * z{k}" for k in range(i))
            out.append(f"{name}_z{i} AS (SELECT *, ({rest}) / l{i}{i} AS z{i} FROM {last})")
            last = f"{name}_z{i}"
        out.append(f"{name} AS (SELECT *, sqrt({' + '.join(f'z{i} * z{i}' for i in p)}) AS dist FROM {last})")
        return out

    start = [
        "mid AS (SELECT lang, source, " + ", ".join(f"quantile_cont(x{i}, 0.5) AS m{i}" for i in p) + " FROM passed GROUP BY ALL)",
        "mad AS (SELECT r.lang, r.source, "
        + ", ".join(f"quantile_cont(abs(x{i} - m{i}), 0.5) AS d{i}" for i in p)
        + f" FROM passed r JOIN mid m ON {on('r', 'm')} GROUP BY ALL)",
    ]
    spread = lambda i: f"greatest(d{i} * 1.4826::DOUBLE, {q.FLOORS[i] * q.SCALE}::DOUBLE)"
    start.append(
        "e0 AS (SELECT mid.*, "
        + ", ".join(f"{spread(i)} * {spread(i)} AS c{i}{j}" if i == j else f"0.0::DOUBLE AS c{i}{j}" for i, j in pairs)
        + f" FROM mid JOIN mad ON {on('mid', 'mad')})"
    )
    steps: list[str] = []
    for s in range(q.STEPS):
        steps += root(f"s{s}", f"e{s}")
        sums = [f"sum(x{i}::HUGEINT)::DOUBLE AS s{i}" for i in p] + [f"sum((x{i} * x{j})::HUGEINT)::DOUBLE AS s{i}{j}" for i, j in pairs]
        steps.append(f"b{s} AS (SELECT lang, source, {x}, least(floor(dist * {q.BINS}), {1 << 40}) AS bin FROM s{s})")
        steps.append(f"n{s} AS (SELECT lang, source, bin, count(*) AS n FROM b{s} GROUP BY ALL)")
        steps.append(
            f"k{s} AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY lang, source ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
            f"AS before, sum(n) OVER (PARTITION BY lang, source) AS total FROM n{s})"
        )
        steps.append(
            f"t{s} AS (SELECT b.lang, b.source, count(*)::DOUBLE AS n, {', '.join(sums)} FROM b{s} b JOIN k{s} k ON {on('b', 'k')} AND b.bin = k.bin "
            f"WHERE before < {q.SUBSET} * total GROUP BY ALL)"
        )
        covariance = [
            f"{q.CONSISTENCY!r}::DOUBLE * (s{i}{j} / n - (s{i} / n) * (s{j} / n)) + {floor2[i] if i == j else 0.0}::DOUBLE AS c{i}{j}"
            for i, j in pairs
        ]
        steps.append(f"e{s + 1} AS (SELECT lang, source, {', '.join(f's{i} / n AS m{i}' for i in p)}, {', '.join(covariance)} FROM t{s})")
    steps += root("last", f"e{q.STEPS}")
    shown = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"
    return rf"""
    WITH raw AS (SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
    lined AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM raw),
    tri AS (SELECT id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM raw)),
    twice AS (SELECT id, i FROM tri QUALIFY count(*) OVER (PARTITION BY id, g) > 1),
    covered AS (SELECT id, count(DISTINCT i + o) AS n FROM twice, range(3) r(o) GROUP BY id),
    counted AS (SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '{q.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines
        FROM lined LEFT JOIN covered USING (id)),
    failed AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEATED} * n_words AS base_failed FROM counted),
    passed AS (SELECT *, round({q.SCALE} * word_chars / n_words::DOUBLE)::BIGINT AS x0,
        round({q.SCALE} * sqrt(n_symbols / n_words::DOUBLE))::BIGINT AS x1,
        round({q.SCALE} * sqrt(n_dup_lines / greatest(n_lines, 1)::DOUBLE))::BIGINT AS x2,
        round({q.SCALE} * n_repeat_words / n_words::DOUBLE)::BIGINT AS x3, round({q.SCALE} * ln(n_words::DOUBLE))::BIGINT AS x4
        FROM failed WHERE NOT base_failed),
    {', '.join(start + steps)}
    SELECT {shown}, dist * dist <= {q.CUTOFF!r}::DOUBLE AS kept FROM last
    UNION ALL SELECT {shown}, false FROM failed WHERE base_failed"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_quality_outliers": quality_outliers(),
        "op5_template_leaks": template_leaks(),
        "op9_source_mix": source_mix(),
    }
