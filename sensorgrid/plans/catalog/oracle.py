"""Derived tables of the oracle SQL, written for DuckDB and independent of the Spark plans."""

from __future__ import annotations

# name -> (tables it reads, SQL)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {}


def table(name: str, sql: str, needs: tuple[str, ...] = ()) -> None:
    TABLES[name] = (needs, sql)


def with_tables(needs: tuple[str, ...], select: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in TABLES[name][0]:
            visit(dep)
        ordered.append(name)

    for name in needs:
        visit(name)
    # Each derived table is computed once, whatever else the optimizer would do with its joins.
    parts = ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n][1].strip()})" for n in ordered)
    return decimal_round(f"WITH {parts}\n{select.strip()}" if parts else select.strip())


def decimal_round(sql: str) -> str:
    """Spells ``round(x, 6)`` out in decimals: sums in another order differ in the last bits,
    and a tie of the seventh digit must not depend on them."""
    out, rest = "", sql
    while (at := rest.find("round(")) >= 0:
        depth, end = 1, at + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[end], 0)
            end += 1
        inner = rest[at + len("round(") : end - 1]
        out += rest[:at]
        if inner.endswith(", 6"):
            out += f"CAST(round(CAST({inner[:-3]} AS DECIMAL(30, 9)), 6) AS DOUBLE)"
        else:
            out += rest[at:end]
        rest = rest[end:]
    return out + rest


table(
    "ev",
    "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
table(
    "readings",
    """SELECT time_bucket(INTERVAL '10 minutes', ts) AS ts, user_id AS sensor_id, value AS count,
        CASE WHEN event_type IN ('error', 'signup') THEN 'archive' ELSE 'history' END AS source,
        event_id AS seq FROM events""",
)
_LAST = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ts, sensor_id
        ORDER BY CASE source WHEN 'archive' THEN 1 ELSE 0 END DESC, seq DESC) AS rn FROM {src}) WHERE rn = 1"""
table("latest", _LAST.format(src="readings"), ("readings",))
_CELLS = """SELECT sensor_id, date_trunc('hour', ts) AS bucket, avg(count) AS value,
        count(count) AS samples FROM {src} GROUP BY 1, 2"""
table("cells", _CELLS.format(src="latest"), ("latest",))


def imputer_tables(cells: str, tag: str, weighting: str = "all", limit: int = 12) -> None:
    """Dense panel and the four layers over ``cells``; names end in ``tag``."""
    table(
        f"buckets{tag}",
        f"""SELECT bucket, row_number() OVER (ORDER BY bucket) - 1 AS pos,
            CAST(bucket + INTERVAL 7 HOUR AS DATE) AS ld,
            CAST(isodow(bucket + INTERVAL 7 HOUR) AS INTEGER) AS weekday,
            CAST(hour(bucket + INTERVAL 7 HOUR) * 3600 AS INTEGER) AS tod
            FROM (SELECT DISTINCT bucket FROM {cells})""",
        (cells,),
    )
    table(
        f"panel{tag}",
        f"""SELECT s.sensor_id, b.bucket, b.pos, b.ld, b.weekday, b.tod, c.value
            FROM buckets{tag} b CROSS JOIN (SELECT DISTINCT sensor_id FROM {cells}) s
            LEFT JOIN {cells} c ON c.sensor_id = s.sensor_id AND c.bucket = b.bucket""",
        (cells, f"buckets{tag}"),
    )
    table(
        f"runs{tag}",
        f"""SELECT *, count(*) FILTER (WHERE value IS NULL)
                OVER (PARTITION BY sensor_id, island) AS run,
            last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER back AS pp,
            last_value(value IGNORE NULLS) OVER back AS pv,
            first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ahead AS np,
            first_value(value IGNORE NULLS) OVER ahead AS nv
            FROM (SELECT *, count(value) OVER (PARTITION BY sensor_id ORDER BY pos
                ROWS UNBOUNDED PRECEDING) AS island FROM panel{tag})
            WINDOW back AS (PARTITION BY sensor_id, ld ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            ahead AS (PARTITION BY sensor_id, ld ORDER BY pos
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
        (f"panel{tag}",),
    )
    table(
        f"linear{tag}",
        f"""SELECT *, CASE WHEN pp IS NOT NULL AND np IS NOT NULL
                THEN pv + (nv - pv) * (CAST(pos - pp AS DOUBLE) / (np - pp)) END AS inside,
            coalesce(pv, nv) AS edge FROM runs{tag}""",
        (f"runs{tag}",),
    )
    table(
        f"temporal{tag}",
        f"""SELECT sensor_id, bucket, weekday, tod,
            CASE WHEN value IS NOT NULL THEN value WHEN run > {limit} THEN NULL
                ELSE coalesce(inside, edge) END AS filled,
            CASE WHEN value IS NOT NULL THEN 'observed' WHEN run > {limit} THEN 'none'
                WHEN coalesce(inside, edge) IS NOT NULL THEN 'temporal' ELSE 'none' END AS filled_by
            FROM linear{tag}""",
        (f"linear{tag}",),
    )
    table(f"holes{tag}", f"SELECT sensor_id, bucket FROM temporal{tag} WHERE filled IS NULL", (f"temporal{tag}",))
    table(f"known{tag}", f"SELECT sensor_id, bucket, filled FROM temporal{tag} WHERE filled IS NOT NULL", (f"temporal{tag}",))
    table(
        f"neighborhood{tag}",
        f"""SELECT h.sensor_id, h.bucket, sum(n.filled * l.w) AS num, sum(l.w) AS total,
            sum(l.w) FILTER (WHERE n.filled IS NOT NULL) AS den,
            count(n.filled) AS available
            FROM holes{tag} h JOIN links{tag} l ON l.sensor_id = h.sensor_id
            LEFT JOIN known{tag} n ON n.sensor_id = l.neighbor AND n.bucket = h.bucket GROUP BY 1, 2""",
        (f"holes{tag}", f"known{tag}", f"links{tag}"),
    )
    table(
        f"links{tag}",
        f"""SELECT src AS sensor_id, dst AS neighbor, 1 / greatest(distance, 1e-6) AS w
            FROM edges WHERE src <> dst AND weight > 0
            AND src IN (SELECT sensor_id FROM {cells}) AND dst IN (SELECT sensor_id FROM {cells})""",
        ("edges", cells),
    )
    guess = "coalesce(num, 0) / total" if weighting == "all" else "num / den"
    table(
        f"spatial{tag}",
        f"""SELECT t.sensor_id, t.bucket, t.weekday, t.tod,
            coalesce(t.filled, {guess}) AS filled,
            CASE WHEN t.filled IS NULL AND {guess} IS NOT NULL THEN 'spatial'
                ELSE t.filled_by END AS filled_by
            FROM temporal{tag} t LEFT JOIN neighborhood{tag} n
            ON n.sensor_id = t.sensor_id AND n.bucket = t.bucket""",
        (f"temporal{tag}", f"neighborhood{tag}"),
    )
    for source, out in ((f"spatial{tag}", f"historical{tag}"), (f"temporal{tag}", f"weekly{tag}")):
        table(
            out,
            f"""SELECT s.sensor_id, s.bucket, s.weekday, s.tod, coalesce(s.filled, p.m) AS filled,
                CASE WHEN s.filled IS NULL AND p.m IS NOT NULL THEN 'historical'
                    ELSE s.filled_by END AS filled_by
                FROM {source} s LEFT JOIN (SELECT sensor_id, weekday, tod, avg(filled) AS m
                    FROM {source} GROUP BY 1, 2, 3) p USING (sensor_id, weekday, tod)""",
            (source,),
        )
    for source, out, threshold in (
        (f"historical{tag}", f"global{tag}", 0.05),
        (f"temporal{tag}", f"rescued{tag}", 0.5),
    ):
        table(
            out,
            f"""SELECT *, CASE WHEN before IS NULL AND rescue IS NOT NULL THEN rescue ELSE before END
                    AS filled, CASE WHEN before IS NULL AND rescue IS NOT NULL THEN 'global'
                    ELSE was END AS filled_by
                FROM (SELECT sensor_id, bucket, weekday, tod, filled AS before, filled_by AS was,
                    CASE WHEN avg(CASE WHEN filled IS NULL THEN 1.0 ELSE 0.0 END)
                        OVER (PARTITION BY sensor_id) < {threshold}
                        THEN avg(filled) OVER (PARTITION BY sensor_id) END AS rescue FROM {source})""",
            (source,),
        )
    table(
        f"clean{tag}",
        f"""SELECT g.sensor_id, g.bucket, g.weekday, g.tod, g.filled, g.filled_by FROM global{tag} g
            JOIN (SELECT sensor_id FROM global{tag} GROUP BY 1 HAVING count(*) = count(filled)) USING (sensor_id)""",
        (f"global{tag}",),
    )


table(
    "hops",
    """SELECT a.user_id AS src, b.user_id AS dst, abs(a.value - b.value) AS gap
        FROM events a JOIN events b ON b.event_id = a.event_id + 1
        WHERE a.event_type = 'error' AND a.value >= 50 AND b.event_type = 'signup'""",
)
table(
    "directed",
    """SELECT src, dst, CAST(count(*) AS DOUBLE) AS weight, min(gap) AS distance
        FROM hops GROUP BY 1, 2""",
    ("hops",),
)
table(
    "edges",
    """SELECT src, dst, CAST(count(*) AS DOUBLE) AS weight, min(gap) AS distance
        FROM (SELECT src, dst, gap FROM hops
            UNION ALL SELECT dst, src, gap FROM hops WHERE src <> dst) GROUP BY 1, 2""",
    ("hops",),
)
table("nodes", "SELECT DISTINCT user_id AS node_id FROM events")
table(
    "linked",
    """SELECT CAST(node AS VARCHAR) AS node_id,
        row_number() OVER (ORDER BY CAST(node AS VARCHAR)) - 1 AS pos
        FROM (SELECT DISTINCT src AS node FROM edges)""",
    ("edges",),
)
table(
    "msgs",
    """SELECT event_id, user_id, k, CAST(user_id % 4 AS INTEGER) AS part,
        (event_id + k * 5) * 1000 + k AS off, ts AS stamp,
        CASE WHEN k = 5 THEN 0 ELSE (epoch_us(ts) // 1000) END AS ms,
        CASE WHEN k = 6 THEN 'node_' || lpad(CAST(user_id AS VARCHAR), 5, '0')
            WHEN k = 7 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS sensor,
        CASE WHEN k = 3 THEN NULL WHEN k = 4 THEN 'x' ELSE CAST(value AS VARCHAR) END AS txt,
        CASE WHEN k IN (2, 3, 4) THEN NULL ELSE value END AS num
        FROM ev""",
    ("ev",),
)
# Messages that decode to an object with a time; broken text decodes to no time.
table("timed", "SELECT * FROM msgs WHERE k NOT IN (0, 1, 5)", ("msgs",))
table(
    "usable",
    "SELECT * FROM timed WHERE sensor IS NOT NULL AND num IS NOT NULL",
    ("timed",),
)
table(
    "snaps",
    """SELECT date_trunc('hour', make_timestamp(ms * 1000)) AS window_start, sensor AS node_id,
        CAST(format('{:.2f}', avg(num)) AS DOUBLE) AS flow, count(*) AS num_samples
        FROM usable GROUP BY 1, 2""",
    ("usable",),
)
imputer_tables("cells", "")
imputer_tables("cells", "_avail", weighting="available")
table(
    "daytime_cells",
    """SELECT sensor_id, bucket, avg(count) AS value FROM (
        SELECT sensor_id, date_trunc('hour', ts) AS bucket, count FROM (
            SELECT *, row_number() OVER (PARTITION BY ts, sensor_id
                ORDER BY CASE source WHEN 'archive' THEN 1 ELSE 0 END DESC, seq DESC) AS rn
            FROM readings WHERE source = 'archive' OR ts >= TIMESTAMP '2024-01-05 00:00:00')
        WHERE rn = 1)
        WHERE hour(bucket + INTERVAL 7 HOUR) BETWEEN 8 AND 22 GROUP BY 1, 2""",
    ("readings",),
)
imputer_tables("daytime_cells", "_day")
table(
    "counts",
    """SELECT count(*) AS cells, count(*) FILTER (WHERE filled_by = 'temporal') AS a,
        count(*) FILTER (WHERE filled_by = 'spatial') AS b,
        count(*) FILTER (WHERE filled_by = 'historical') AS c,
        count(*) FILTER (WHERE filled_by = 'global') AS d,
        count(*) FILTER (WHERE filled_by <> 'observed') AS holes FROM global""",
    ("global",),
)
table(
    "series",
    """SELECT c.sensor_id, b.pos, b.ld, c.filled AS value,
        CASE WHEN b.pos < n.cut THEN 'train' ELSE 'val' END AS split,
        CASE WHEN b.pos < n.cut THEN b.pos ELSE b.pos - n.cut END AS step
        FROM clean_avail c JOIN buckets_avail b USING (bucket),
        (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) AS cut FROM buckets_avail) n""",
    ("clean_avail", "buckets_avail"),
)
