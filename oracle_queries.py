"""DuckDB SQL for each registered query (the correctness oracle).

views as CTEs (FIXTURES.md section 2), the chart queries as plain
GROUP BY / ROW_NUMBER SQL, the similarity predicate on every pair of a
market (brute force), and declumping as chained LAG windows.  Tables
``region nation customer supplier part orders lineitem events`` are the
driver's pre-registered views.
"""

from __future__ import annotations

STOP_WORDS_SQL = "['of', 'and', 'or', 'feat', 'featuring', 'ft', 'the']"
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ALL_MARKETS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
ISRC = "p_brand || '-' || CAST(p_size AS VARCHAR)"


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def fixtures() -> list[str]:
    return [
        """nr AS (SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)""",
        """cr AS (SELECT c.c_custkey, CASE WHEN c.c_acctbal >= 0 THEN c.c_mktsegment END AS segment_name, nr.r_name AS c_region
                 FROM customer c JOIN nr ON c.c_nationkey = nr.n_nationkey)""",
        """sr AS (SELECT s.s_suppkey, nr.r_name AS s_region FROM supplier s JOIN nr ON s.s_nationkey = nr.n_nationkey)""",
        """lines AS (SELECT l.l_partkey, l.l_linenumber, l.l_quantity, l.l_linestatus, l.l_shipdate,
                           o.o_custkey, cr.c_region, sr.s_region
                    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                    JOIN cr ON o.o_custkey = cr.c_custkey JOIN sr ON l.l_suppkey = sr.s_suppkey)""",
        """fs_all AS (SELECT l_partkey AS partner_info_key, o_custkey AS consumer_key,
                            CAST(l_quantity AS BIGINT) AS num_streams,
                            CAST(date_trunc('year', l_shipdate) AS DATE) AS report_date,
                            s_region AS country_code_stream, c_region AS country_code,
                            l_linenumber AS source_type_key, l_linestatus FROM lines)""",
        """fs_sme AS (SELECT * EXCLUDE (l_linestatus) FROM fs_all WHERE l_linestatus = 'O')""",
        """fs_orch AS (SELECT * EXCLUDE (l_linestatus) FROM fs_all WHERE l_linestatus = 'F')""",
        f"""dpi AS (SELECT p_partkey AS partner_info_key, p_partkey AS product_key, {ISRC} AS track_isrc,
                          'track:' || replace(p_name, ' ', '-') || ':' || CAST(p_partkey AS VARCHAR) AS track_uri,
                          p_name AS track_artists, p_type || ' ' || p_name AS track_name FROM part)""",
        """vpg AS (SELECT p_partkey AS product_key, p_type AS primary_genre FROM part
                  UNION ALL
                  SELECT p_partkey, 'ALT ' || p_type FROM part WHERE p_partkey % 20 = 0)""",
        """scs AS (SELECT c_custkey AS consumer_key, c_region AS country_code, segment_name FROM cr)""",
        f"""vrtd AS (SELECT {ISRC} AS isrc, p_type AS genre_name, CAST(l_shipdate AS DATE) AS release_date
                    FROM part JOIN lineitem ON p_partkey = l_partkey)""",
        f"""cm_tracks AS (SELECT {ISRC} AS isrc, p_partkey AS album_id FROM part)""",
        """cm_albums AS (SELECT l_partkey AS album_id, CAST(o_orderdate AS DATE) AS release_date
                        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
        f"""dp AS (SELECT {ISRC} AS isrc_cd, p_partkey AS product_key FROM part)""",
        """dpr AS (SELECT l_partkey AS product_key, CAST(l_shipdate AS DATE) AS release_date
                  FROM lineitem)""",
        """fv_all AS (SELECT CAST(regexp_extract(e.props, '"k":\\s*(-?[0-9]+)', 1) AS BIGINT) AS partner_info_key,
                            CAST(round(e.value * 100) AS BIGINT) AS creations, cr.c_region AS country_code,
                            CAST(e.ts AS DATE) AS report_date, e.event_type
                     FROM events e JOIN cr ON e.user_id = cr.c_custkey)""",
        """fv_sme AS (SELECT * EXCLUDE (event_type) FROM fv_all WHERE event_type = 'view')""",
        """fv_orch AS (SELECT * EXCLUDE (event_type) FROM fv_all WHERE event_type <> 'view')""",
        f"""dpi_tt AS (SELECT p_partkey AS partner_info_key, {ISRC} AS isrc_cd, p_name AS artist_name,
                             p_type || ' ' || p_name AS track_title FROM part)""",
        """load_status AS (
              SELECT country_code, 'streams_sme' AS fact_table, max(report_date) AS max_report_date FROM fs_sme GROUP BY 1
              UNION ALL SELECT country_code, 'streams_orchard', max(report_date) FROM fs_orch GROUP BY 1
              UNION ALL SELECT country_code, 'views_sme', max(report_date) FROM fv_sme GROUP BY 1
              UNION ALL SELECT country_code, 'views_orchard', max(report_date) FROM fv_orch GROUP BY 1)""",
    ]


def tokens_expr(col: str) -> str:
    """Artist tokens: lower, keep letters/digits/_/space, drop stop words, distinct; [''] if none."""
    words = (
        f"list_filter(string_split_regex(regexp_replace(lower({col}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+'), "
        f"lambda x: x <> '' AND NOT list_contains({STOP_WORDS_SQL}, x))"
    )
    return (
        f"CASE WHEN {col} IS NULL THEN NULL WHEN len({words}) = 0 THEN [''] "
        f"ELSE list_distinct({words}) END"
    )


def chart_ctes(
    s: str = "",
    day: str = "2000-01-01",
    markets=("EUROPE",),
    run_date: str = "2001-01-01",
    home: str = "EUROPE",
    sources=(4, 7),
    cover_days: int = 730,
    n_sme: int = 5000,
    n_orch: int = 500,
    watermark: bool = False,
) -> list[str]:
    """The chart job for one day (or each market's streams watermark);
    every CTE name carries the suffix ``s``."""
    mk = _in(markets)
    if watermark:
        day_pred = (f"(f.country_code_stream, f.report_date) IN (SELECT country_code, min(max_report_date) "
                    f"FROM load_status WHERE fact_table IN ('streams_sme', 'streams_orchard') GROUP BY 1)")
    else:
        day_pred = f"f.report_date = DATE '{day}'"
    src = ", ".join(str(x) for x in sources)
    out = []
    for feed, fs, n in (("sme", "fs_sme", n_sme), ("orch", "fs_orch", n_orch)):
        genre_join = "JOIN vpg g USING (product_key)" if feed == "sme" else ""
        genre_col = "min(g.primary_genre)" if feed == "sme" else "CAST(NULL AS VARCHAR)"
        out.append(f"""top0_{feed}{s} AS (
            SELECT f.country_code_stream AS market, d.track_isrc,
                   min(d.track_uri) AS _track_uri, min(d.track_artists) AS _track_artist,
                   min(d.track_name) AS _track_name, {genre_col} AS _primary_genre,
                   CAST(sum(f.num_streams) AS BIGINT) AS total_streams
            FROM {fs} f JOIN dpi d USING (partner_info_key) {genre_join}
            WHERE {day_pred} AND f.country_code_stream IN ({mk})
            GROUP BY 1, 2)""")
        out.append(f"""top1_{feed}{s} AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY market ORDER BY total_streams DESC NULLS LAST,
                   track_isrc ASC NULLS LAST) AS INTEGER) AS top_rank FROM top0_{feed}{s})""")
        if feed == "sme":
            out.append(f"""top_{feed}{s} AS (SELECT * FROM top1_{feed}{s} WHERE top_rank <= {n})""")
        else:
            out.append(f"""ol{s} AS (SELECT isrc AS track_isrc, min(genre_name) AS _primary_genre FROM vrtd GROUP BY 1)""")
            out.append(f"""top_{feed}{s} AS (
                SELECT t.market, t.top_rank, t.track_isrc, t._track_uri, t._track_artist, t._track_name,
                       ol._primary_genre, t.total_streams
                FROM top1_{feed}{s} t LEFT JOIN ol{s} ol ON t.track_isrc = ol.track_isrc
                WHERE t.top_rank <= {n})""")
        out.append(f"""seg_{feed}{s} AS (
            SELECT f.country_code_stream AS market, d.track_isrc, sc.segment_name,
                   min(t._track_uri) AS _track_uri, min(t._track_artist) AS _track_artist,
                   min(t._track_name) AS _track_name, min(t._primary_genre) AS _primary_genre,
                   CAST(sum(f.num_streams) AS BIGINT) AS segment_streams, max(t.total_streams) AS total_streams
            FROM {fs} f JOIN dpi d USING (partner_info_key)
            JOIN top_{feed}{s} t ON t.market = f.country_code_stream AND t.track_isrc = d.track_isrc
            LEFT JOIN scs sc ON sc.consumer_key = f.consumer_key AND sc.country_code = f.country_code
            WHERE {day_pred} AND f.country_code_stream IN ({mk})
            GROUP BY 1, 2, 3)""")
        out.append(f"""cov_{feed}{s} AS (
            SELECT track_isrc, track_uri AS track_uri_fs, cover_streams FROM (
                SELECT d.track_isrc, d.track_uri, CAST(sum(f.num_streams) AS BIGINT) AS cover_streams,
                       row_number() OVER (PARTITION BY d.track_isrc ORDER BY sum(f.num_streams) DESC NULLS FIRST,
                                          d.track_uri ASC NULLS LAST) AS cover_no
                FROM {fs} f JOIN dpi d USING (partner_info_key)
                WHERE f.country_code = '{home}' AND f.source_type_key IN ({src})
                  AND f.report_date BETWEEN DATE '{run_date}' - {cover_days} AND DATE '{run_date}'
                GROUP BY 1, 2) WHERE cover_no = 1)""")
        out.append(f"""ft_{feed}{s} AS (
            SELECT sg.market, sg.track_isrc, sg.segment_name,
                   coalesce(c.track_uri_fs, sg._track_uri) AS _track_uri, sg._track_artist, sg._track_name,
                   sg._primary_genre, sg.segment_streams, sg.total_streams,
                   '{"SME" if feed == "sme" else "ORCHARD"}' AS feed
            FROM seg_{feed}{s} sg LEFT JOIN cov_{feed}{s} c ON sg.track_isrc = c.track_isrc)""")
    out.append(f"""tracks{s} AS (SELECT * FROM ft_sme{s} UNION ALL SELECT * FROM ft_orch{s})""")
    out.append(f"""meta{s} AS (
        SELECT market, track_isrc, _track_uri, _track_artist, _track_name, _primary_genre, total_streams, feed
        FROM (SELECT *, row_number() OVER (PARTITION BY market, track_isrc
                        ORDER BY CASE feed WHEN 'SME' THEN 0 WHEN 'ORCHARD' THEN 1 ELSE 2 END) AS rn
              FROM tracks{s}) WHERE rn = 1)""")
    out.append(f"""rel{s} AS (
        SELECT track_isrc, min(release_date) AS release_date FROM (
            SELECT s.isrc AS track_isrc, min(a.release_date) AS release_date
            FROM cm_tracks s JOIN cm_albums a USING (album_id)
            WHERE s.isrc IN (SELECT track_isrc FROM meta{s}) GROUP BY 1
            UNION ALL
            SELECT p.isrc_cd AS track_isrc, min(r.release_date) AS release_date
            FROM dp p JOIN dpr r USING (product_key)
            WHERE p.isrc_cd IN (SELECT track_isrc FROM meta{s}) GROUP BY 1
            UNION ALL
            SELECT v.isrc AS track_isrc, min(v.release_date) AS release_date
            FROM vrtd v WHERE v.isrc IN (SELECT track_isrc FROM meta{s}) GROUP BY 1)
        GROUP BY 1)""")
    seg_cols = ",\n".join(
        f"""CASE WHEN count(segment_name) > 0 THEN
              CAST(coalesce(sum(CASE WHEN segment_name = '{g}' THEN segment_streams END), 0) AS DOUBLE)
              / nullif(CAST(sum(CASE WHEN segment_name IS NOT NULL THEN segment_streams END) AS DOUBLE), 0) * 100
            END AS {g}"""
        for g in SEGMENTS
    )
    out.append(f"""shares{s} AS (
        SELECT market, track_isrc, {seg_cols},
               CAST(coalesce(sum(CASE WHEN segment_name IS NULL THEN segment_streams END), 0) AS DOUBLE)
               / nullif(CAST(sum(segment_streams) AS DOUBLE), 0) AS share_of_none_values
        FROM tracks{s} GROUP BY 1, 2)""")
    seg_sel = ", ".join(f"sh.{g}" for g in SEGMENTS)
    out.append(f"""chart{s} AS (
        SELECT m.market,
               CAST(row_number() OVER (PARTITION BY m.market ORDER BY m.total_streams DESC NULLS LAST,
                    m.track_isrc ASC NULLS LAST) AS INTEGER) AS chart_rank,
               m.track_isrc, m._track_uri, m._track_artist, m._track_name, m._primary_genre, m.total_streams,
               m.feed, r.release_date, {seg_sel}, sh.share_of_none_values
        FROM meta{s} m JOIN shares{s} sh ON m.market = sh.market AND m.track_isrc = sh.track_isrc
        LEFT JOIN rel{s} r ON m.track_isrc = r.track_isrc)""")
    return out


def _theme_predicates(rap="BUILDING", edm="MACHINERY", pattern="rod|large", catalogue_run="1999-01-01"):
    rx = f"coalesce(regexp_matches(_track_uri, '{pattern}', 'i'), false)"
    return {
        "top": ("true", 4),
        "rap": (f"coalesce({rap} > 75.0, false) OR {rx}", 4),
        "gaming": (
            f"coalesce({edm} > 25.0, false) OR (coalesce({rap} > 55.0, false) AND coalesce({edm} > 1.0, false)) OR {rx}",
            0,
        ),
        "party": (f"coalesce({edm} > 20.0, false) OR {rx}", 4),
        "catalogue": (f"coalesce(release_date <= DATE '{catalogue_run}' - 56, false)", 4),
    }


def declump_ctes(src: str, name: str, max_passes: int) -> list[str]:
    """Chained passes; a list whose ``passes`` column is below k skips pass k."""
    out = [f"""{name}_t AS (SELECT *, {tokens_expr('_track_artist')} AS tokens FROM {src})"""]
    prev = f"{name}_t"
    for k in range(1, max_passes + 1):
        out.append(f"""{name}_k{k} AS (
            SELECT *, CASE WHEN passes >= {k} AND coalesce(list_has_any(tokens,
                            lag(tokens) OVER (PARTITION BY market, playlist ORDER BY position)), false)
                       THEN position + 2.5 ELSE CAST(position AS DOUBLE) END AS k_{k} FROM {prev})""")
        out.append(f"""{name}_p{k} AS (
            SELECT * EXCLUDE (position, k_{k}),
                   CAST(row_number() OVER (PARTITION BY market, playlist ORDER BY k_{k}) AS INTEGER) AS position
            FROM {name}_k{k})""")
        prev = f"{name}_p{k}"
    out.append(f"""{name} AS (SELECT * EXCLUDE (tokens) FROM {prev})""")
    return out


def playlist_ctes(s: str = "", names=("top", "rap", "gaming", "party", "catalogue"), passes_override=None,
                  length: int = 150, market_lists=()) -> list[str]:
    preds = _theme_predicates()
    parts = []
    for nm in names:
        pred, passes = preds[nm]
        if passes_override is not None:
            passes = passes_override
        parts.append(f"""SELECT market, '{nm}' AS playlist, {passes} AS passes, chart_rank, track_isrc,
                                _track_uri, _track_artist FROM chart{s} WHERE {pred}""")
    union = " UNION ALL ".join(parts)
    for market, lists, passes in market_lists:
        union = f"""SELECT * REPLACE (CASE WHEN market = '{market}' AND playlist = 'top' THEN {passes} ELSE passes END AS passes)
                    FROM ({union}) WHERE market <> '{market}' OR playlist IN ({_in(lists)})"""
    out = [f"""sel{s} AS (
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY market, playlist ORDER BY chart_rank) AS INTEGER) AS position
            FROM ({union})) WHERE position <= {length})"""]
    max_passes = max(passes_override or 0, *(preds[nm][1] for nm in names))
    out += declump_ctes(f"sel{s}", f"lists{s}", max_passes)
    return out


def short_video_ctes(day: str = "2024-01-30", markets=("EUROPE",), n_sme: int = 250, n_orch: int = 50,
                     watermark: bool = False) -> list[str]:
    mk = _in(markets)
    day_pred = f"f.report_date = DATE '{day}'"
    if watermark:
        day_pred = ("(f.country_code, f.report_date) IN (SELECT country_code, min(max_report_date) FROM load_status "
                    "WHERE fact_table = 'views_sme' GROUP BY 1)")
    out = []
    for feed, fv, n in (("SME", "fv_sme", n_sme), ("ORCHARD", "fv_orch", n_orch)):
        out.append(f"""sv_{feed} AS (
            SELECT * FROM (
                SELECT market, '{feed}' AS feed, isrc_cd, _artist_name_tt, _track_name_tt, tt_creations,
                       CAST(row_number() OVER (PARTITION BY market ORDER BY tt_creations DESC NULLS LAST,
                            isrc_cd ASC NULLS LAST) AS INTEGER) AS tt_rank
                FROM (SELECT f.country_code AS market, d.isrc_cd, min(d.artist_name) AS _artist_name_tt,
                             min(d.track_title) AS _track_name_tt, CAST(sum(f.creations) AS BIGINT) AS tt_creations
                      FROM {fv} f JOIN dpi_tt d USING (partner_info_key)
                      WHERE f.country_code IN ({mk}) AND {day_pred}
                      GROUP BY 1, 2))
            WHERE tt_rank <= {n})""")
    out.append("""sv AS (SELECT * FROM sv_SME UNION ALL SELECT * FROM sv_ORCHARD)""")
    return out


def _char_counts_cte(name: str, src: str, key: str, col: str) -> str:
    """(key, ch, cnt) of lower(col) without ASCII punctuation."""
    return f"""{name} AS (
        SELECT {key}, ch, count(*) AS cnt FROM (
            SELECT {key}, unnest(string_split(regexp_replace(lower({col}), '[!-/:-@\\[-`{{-~]', '', 'g'), '')) AS ch
            FROM {src}) WHERE ch <> '' GROUP BY ALL)"""


def cosine_ctes(name: str, left_src: str, lkey: str, lcol: str, right_src: str, rkey: str, rcol: str,
                pair_src: str) -> list[str]:
    """Cosine of character counts for every row of ``pair_src`` (which has lkey, rkey columns)."""
    return [
        _char_counts_cte(f"{name}_l", left_src, lkey, lcol),
        _char_counts_cte(f"{name}_r", right_src, rkey, rcol),
        f"""{name}_ln AS (SELECT {lkey}, sum(cnt * cnt) AS n2 FROM {name}_l GROUP BY ALL)""",
        f"""{name}_rn AS (SELECT {rkey}, sum(cnt * cnt) AS n2 FROM {name}_r GROUP BY ALL)""",
        f"""{name}_dot AS (
            SELECT p.{lkey.replace(', ', ', p.')}, p.{rkey.replace(', ', ', p.')}, sum(a.cnt * b.cnt) AS d
            FROM {pair_src} p JOIN {name}_l a USING ({lkey}) JOIN {name}_r b USING ({rkey})
            WHERE a.ch = b.ch GROUP BY ALL)""",
        f"""{name} AS (
            SELECT p.*, CASE WHEN ln.n2 > 0 AND rn.n2 > 0
                             THEN CAST(coalesce(dt.d, 0) AS DOUBLE) / (sqrt(CAST(ln.n2 AS DOUBLE)) * sqrt(CAST(rn.n2 AS DOUBLE)))
                             ELSE 0.0 END AS sim
            FROM {pair_src} p LEFT JOIN {name}_ln ln USING ({lkey}) LEFT JOIN {name}_rn rn USING ({rkey})
            LEFT JOIN {name}_dot dt USING ({lkey}, {rkey}))""",
    ]


def fuzzy_ctes(depth: int = 500, t_name: float = 0.9, t_artist: float = 0.9) -> list[str]:
    out = [
        f"""c500 AS (SELECT market, chart_rank, track_isrc, _track_uri, _track_artist, _track_name
                     FROM chart WHERE chart_rank <= {depth})""",
        """svk AS (SELECT market AS tmarket, feed AS tt_feed, tt_rank, isrc_cd, _artist_name_tt, _track_name_tt,
                          tt_creations FROM sv)""",
        # every pair of a market: the brute-force reference
        """allpairs AS (SELECT c.market, c.chart_rank, s.tt_feed, s.tt_rank FROM c500 c JOIN svk s ON c.market = s.tmarket)""",
        """c500k AS (SELECT market, chart_rank, _track_name, _track_artist FROM c500)""",
        """svkk AS (SELECT tmarket AS market, tt_feed, tt_rank, _track_name_tt, _artist_name_tt FROM svk)""",
    ]
    out += cosine_ctes("cos_n", "c500k", "market, chart_rank", "_track_name", "svkk", "market, tt_feed, tt_rank",
                       "_track_name_tt", "allpairs")
    out += cosine_ctes("cos_a", "c500k", "market, chart_rank", "_track_artist", "svkk", "market, tt_feed, tt_rank",
                       "_artist_name_tt", "allpairs")
    out.append(f"""pairs AS (
        SELECT c.market, c.chart_rank, c.track_isrc, c._track_uri, c._track_artist, c._track_name,
               s.tt_feed, s.tt_rank, s.isrc_cd, s._artist_name_tt, s._track_name_tt, s.tt_creations,
               n.sim AS sim_name, a.sim AS sim_artist
        FROM cos_n n JOIN cos_a a USING (market, chart_rank, tt_feed, tt_rank)
        JOIN c500 c USING (market, chart_rank)
        JOIN svk s ON s.tmarket = n.market AND s.tt_feed = n.tt_feed AND s.tt_rank = n.tt_rank
        WHERE (n.sim >= {t_name} AND a.sim >= {t_artist}) OR coalesce(c.track_isrc = s.isrc_cd, false))""")
    return out


def viral_ctes(length: int = 150) -> list[str]:
    out = [
        f"""vsel AS (
            SELECT * FROM (
                SELECT market, _track_uri, chart_rank, tt_feed, tt_rank, track_isrc, _track_artist, _track_name,
                       isrc_cd, tt_creations, 'viral' AS playlist, 4 AS passes,
                       CAST(row_number() OVER (PARTITION BY market ORDER BY tt_creations DESC NULLS LAST,
                            chart_rank) AS INTEGER) AS position
                FROM (SELECT *, row_number() OVER (PARTITION BY market, _track_uri ORDER BY chart_rank,
                                CASE tt_feed WHEN 'SME' THEN 0 WHEN 'ORCHARD' THEN 1 ELSE 2 END, tt_rank) AS rn
                      FROM pairs) WHERE rn = 1)
            WHERE position <= {length})""",
    ]
    out += declump_ctes("vsel", "viral", 4)
    return out


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _chart_cols() -> str:
    return ("market, chart_rank, track_isrc, _track_uri, _track_artist, _track_name, _primary_genre, "
            "total_streams, feed, release_date, " + ", ".join(SEGMENTS) + ", share_of_none_values")


LIST_COLS = "market, playlist, position, chart_rank, track_isrc, _track_uri, _track_artist"


def oracle_sql() -> dict[str, str]:
    fx = fixtures()
    ch = fx + chart_ctes()
    pl = ch + playlist_ctes()
    sv = fx + short_video_ctes()
    fz = ch + short_video_ctes() + fuzzy_ctes()
    q: dict[str, str] = {}

    q["load_watermark"] = _with(fx, f"""
        SELECT country_code AS market, min(max_report_date) AS watermark,
               CAST(count(DISTINCT fact_table) AS INTEGER) AS n_tables
        FROM load_status WHERE fact_table IN ('streams_sme', 'streams_orchard')
          AND country_code IN ({_in(ALL_MARKETS)}) GROUP BY 1""")
    top_cols = "market, top_rank, track_isrc, _track_uri, _track_artist, _track_name, _primary_genre, total_streams"
    q["top_tracks_sme"] = _with(ch, f"SELECT {top_cols} FROM top_sme")
    q["top_tracks_orchard"] = _with(ch, f"SELECT {top_cols} FROM top_orch")
    seg_cols = ("market, track_isrc, segment_name, _track_uri, _track_artist, _track_name, _primary_genre, "
                "segment_streams, total_streams")
    q["segment_streams_sme"] = _with(ch, f"SELECT {seg_cols} FROM seg_sme")
    q["segment_streams_orchard"] = _with(ch, f"SELECT {seg_cols} FROM seg_orch")
    q["best_cover"] = _with(ch, "SELECT track_isrc, track_uri_fs, cover_streams FROM cov_sme")
    q["best_cover_orchard"] = _with(ch, "SELECT track_isrc, track_uri_fs, cover_streams FROM cov_orch")
    q["feed_tracks"] = _with(ch, f"SELECT {seg_cols}, feed FROM tracks")
    q["track_metadata"] = _with(ch, "SELECT * FROM meta")
    q["earliest_release"] = _with(ch, "SELECT track_isrc, release_date FROM rel")
    q["segment_shares"] = _with(ch, "SELECT * FROM shares")
    q["chart"] = _with(ch, f"SELECT {_chart_cols()} FROM chart")
    q["chart_at_watermark"] = _with(fx + chart_ctes(markets=ALL_MARKETS, watermark=True),
                                    f"SELECT {_chart_cols()} FROM chart")
    q["artist_tokens"] = _with(fx + [f"tk AS (SELECT partner_info_key, track_artists, {tokens_expr('track_artists')} AS t FROM dpi)"], """
        SELECT partner_info_key, track_artists, array_to_string(list_sort(t), '|') AS tokens,
               CAST(len(t) AS INTEGER) AS n_tokens FROM tk""")

    top_only = ch + [f"""sel1 AS (SELECT market, 'top' AS playlist, PASSES AS passes, chart_rank, track_isrc,
                                        _track_uri, _track_artist, chart_rank AS position
                                 FROM chart WHERE chart_rank <= 150)"""]
    for name, k in (("declump_once", 1), ("declump_four", 4)):
        ctes = [c.replace("PASSES", str(k)) for c in top_only] + declump_ctes("sel1", "dl", k)
        q[name] = _with(ctes, f"SELECT {LIST_COLS} FROM dl")
    q["playlist_top_plain"] = _with([c.replace("PASSES", "0") for c in top_only], f"SELECT {LIST_COLS} FROM sel1")
    for nm in ("top", "rap", "gaming", "party", "catalogue"):
        q[f"playlist_{nm}"] = _with(pl, f"SELECT {LIST_COLS} FROM lists WHERE playlist = '{nm}'")

    allm = fx + chart_ctes(markets=ALL_MARKETS) + playlist_ctes(names=("top",))
    q["playlist_top_by_market"] = _with(allm, f"SELECT {LIST_COLS} FROM lists")

    q["short_video_top"] = _with(sv, """
        SELECT market, feed, tt_rank, isrc_cd, _artist_name_tt, _track_name_tt, tt_creations FROM sv""")

    cc = fx + [
        """pp AS (SELECT partner_info_key, track_name, track_artists, p_brand FROM dpi JOIN part ON p_partkey = partner_info_key)""",
        """pk AS (SELECT partner_info_key, partner_info_key AS rk FROM pp)""",
        """pl AS (SELECT partner_info_key, track_name FROM pp)""",
        """pr AS (SELECT partner_info_key AS rk, track_artists FROM pp)""",
        """pb AS (SELECT partner_info_key AS rk, p_brand FROM pp)""",
    ] + cosine_ctes("c1", "pl", "partner_info_key", "track_name", "pr", "rk", "track_artists", "pk") \
      + cosine_ctes("c2", "pl", "partner_info_key", "track_name", "pb", "rk", "p_brand", "pk")
    q["char_cosine"] = _with(cc, """
        SELECT pp.partner_info_key, pp.track_name, pp.track_artists, pp.p_brand,
               c1.sim AS sim_name_artist, c2.sim AS sim_name_brand
        FROM pp JOIN c1 USING (partner_info_key) JOIN c2 USING (partner_info_key)""")

    pair_cols = ("market, chart_rank, track_isrc, _track_uri, _track_artist, _track_name, tt_feed, tt_rank, "
                 "isrc_cd, _artist_name_tt, _track_name_tt, tt_creations, sim_name, sim_artist")
    q["fuzzy_pairs"] = _with(fz, f"SELECT {pair_cols} FROM pairs")
    q["playlist_viral"] = _with(fz + viral_ctes(), """
        SELECT market, playlist, position, chart_rank, track_isrc, _track_uri, _track_artist, tt_creations
        FROM viral""")

    q["publish_batches"] = _with(pl, f"""
        SELECT market, playlist, CAST(batch_no AS INTEGER) AS batch_no,
               CAST(max(batch_no) OVER (PARTITION BY market, playlist) - batch_no AS INTEGER) AS send_order,
               0 AS insert_at, CAST(n_uris AS INTEGER) AS n_uris, uri_list,
               'Dane na dzien ' || strftime(DATE '2000-01-01', '%Y-%m-%d') AS description
        FROM (SELECT market, playlist, (position - 1) // 100 AS batch_no, count(*) AS n_uris,
                     string_agg(_track_uri, ',' ORDER BY position) AS uri_list
              FROM lists GROUP BY 1, 2, 3)""")

    old = fx + chart_ctes(s="_o", day="1999-01-01") + playlist_ctes(s="_o", names=("top",))
    new = chart_ctes(s="_n", day="2000-01-01") + playlist_ctes(s="_n", names=("top",))
    q["playlist_diff"] = _with(old + new, """
        SELECT market, playlist, _track_uri AS track_uri, 'added' AS change FROM (
            SELECT market, playlist, _track_uri FROM lists_n EXCEPT SELECT market, playlist, _track_uri FROM lists_o)
        UNION ALL
        SELECT market, playlist, _track_uri, 'removed' FROM (
            SELECT market, playlist, _track_uri FROM lists_o EXCEPT SELECT market, playlist, _track_uri FROM lists_n)""")

    awkward = _chart_cols().replace("_track_name", "' ' || _track_name || ' \"live\"' || chr(10) || ', 2 ' AS _track_name").replace(
        "_primary_genre", "CASE WHEN feed = 'SME' THEN _primary_genre ELSE '' END AS _primary_genre")
    q["csv_roundtrip"] = _with(ch, f"SELECT {awkward} FROM chart")
    q["bulk_load_csv"] = _with(ch, f"""
        SELECT market, track_isrc, segment_name, _track_uri, _track_artist, substr(_track_name, 1, 12) AS _track_name,
               _primary_genre, segment_streams, total_streams, feed FROM tracks""")
    q["playlist_snapshot"] = _with(pl, f"SELECT market, playlist, position, _track_uri AS track_uri FROM lists")

    fields = ["market", "track_isrc", "segment_name", "_track_uri", "_track_artist", "_track_name", "_primary_genre",
              "'n/a'", "CAST(total_streams AS VARCHAR)", "feed"]
    line = " || ',' || ".join(f"coalesce({f}, '')" for f in fields)
    q["bulk_load_rejects"] = _with(ch, f"SELECT {line} AS line FROM tracks WHERE segment_name IS NULL")
    q["file_inventory"] = _with(fx, """
        SELECT '' AS path, 'market=' || country_code AS name, false AS is_file FROM scs GROUP BY country_code
        UNION ALL SELECT '/market=' || country_code, '*', true FROM scs GROUP BY country_code""")

    q["top_tracks_sme_100"] = _with(fx + chart_ctes(n_sme=100), f"SELECT {top_cols} FROM top_sme")
    q["top_tracks_orchard_50"] = _with(fx + chart_ctes(n_orch=50), f"SELECT {top_cols} FROM top_orch")
    video_cols = "market, feed, tt_rank, isrc_cd, _artist_name_tt, _track_name_tt, tt_creations"
    q["short_video_top_10_5"] = _with(fx + short_video_ctes(n_sme=10, n_orch=5), f"SELECT {video_cols} FROM sv")
    q["short_video_at_watermark"] = _with(fx + short_video_ctes(markets=ALL_MARKETS, watermark=True),
                                          f"SELECT {video_cols} FROM sv")
    q["playlist_viral_20"] = _with(fz + viral_ctes(20), f"SELECT {LIST_COLS}, tt_creations FROM viral")

    everywhere = (fx + chart_ctes(markets=ALL_MARKETS) + short_video_ctes(markets=ALL_MARKETS) + fuzzy_ctes() + viral_ctes())
    by_market = (("AFRICA", ("top",), 0), ("AMERICA", ("top",), 4), ("ASIA", ("top",), 4), ("MIDDLE EAST", ("top",), 2))
    q["playlist_lists_by_market"] = _with(everywhere + playlist_ctes(market_lists=by_market), f"""
        SELECT {LIST_COLS} FROM lists UNION ALL SELECT {LIST_COLS} FROM viral WHERE market = 'EUROPE'""")
    daily = everywhere + playlist_ctes() + ["""daily AS (
        SELECT market, playlist, position, _track_uri FROM lists UNION ALL
        SELECT market, playlist, position, _track_uri FROM viral)"""]
    q["daily_batches"] = _with(daily, """
        SELECT market, playlist, CAST(batch_no AS INTEGER) AS batch_no,
               CAST(max(batch_no) OVER (PARTITION BY market, playlist) - batch_no AS INTEGER) AS send_order,
               0 AS insert_at, CAST(n_uris AS INTEGER) AS n_uris, uri_list,
               'Dane na dzien ' || strftime(DATE '2000-01-01', '%Y-%m-%d') AS description
        FROM (SELECT market, playlist, (position - 1) // 100 AS batch_no, count(*) AS n_uris,
                     string_agg(_track_uri, ',' ORDER BY position) AS uri_list
              FROM daily GROUP BY 1, 2, 3)""")
    markets = ", ".join(f"('{m}')" for m in ALL_MARKETS)
    names = ", ".join(f"('{n}')" for n in ("top", "rap", "gaming", "party", "catalogue", "viral"))
    q["daily_manifest"] = _with(daily, f"""
        SELECT m.market, n.playlist, 'Dane na dzien 2000-01-01' AS description, '2000-01-01' AS as_of,
               CAST(coalesce(c.n, 0) AS INTEGER) AS n_tracks
        FROM (VALUES {markets}) m(market) CROSS JOIN (VALUES {names}) n(playlist)
        LEFT JOIN (SELECT market, playlist, count(*) AS n FROM daily GROUP BY 1, 2) c
          ON c.market = m.market AND c.playlist = n.playlist""")
    q["playlist_items"] = _with(pl, "SELECT market, playlist, position, _track_uri AS track_uri FROM lists")
    odd = "(length(_track_name) + length(coalesce(segment_name, ''))) % 3"
    q["csv_by_name"] = _with(ch, f"""
        SELECT market, track_isrc, segment_name, _track_uri, _track_artist, _track_name,
               CASE WHEN {odd} <> 2 THEN _primary_genre END AS _primary_genre,
               CASE WHEN {odd} = 2 AND feed <> 'SME' THEN 'n/a' ELSE CAST(segment_streams AS VARCHAR) END AS segment_streams,
               total_streams, feed FROM tracks""")
    names = ["market", "track_isrc", "segment_name", "_track_uri", "_track_artist", "_track_name", "_primary_genre",
             "segment_streams", "total_streams", "feed"]
    moved = " UNION ALL ".join(f"SELECT 'turned', '{c}', 'moved', CAST(NULL AS BIGINT)" for c in names)
    q["csv_drift"] = _with(ch, f"""
        SELECT 'turned' AS delivery, 'comment' AS "column", 'extra' AS change, CAST(NULL AS BIGINT) AS n
        UNION ALL {moved}
        UNION ALL SELECT 'short', '_primary_genre', 'missing', NULL
        UNION ALL SELECT 'short', 'segment_streams', 'retyped', count(*) FROM tracks WHERE {odd} = 2 AND feed <> 'SME' HAVING count(*) > 0""")

    two = (fx + chart_ctes(s="_o", day="1999-01-01", markets=ALL_MARKETS) + playlist_ctes(s="_o", names=("top",))
           + chart_ctes(s="_n", day="2000-01-01", markets=ALL_MARKETS) + playlist_ctes(s="_n", names=("top",)))
    q["playlist_edit_replay"] = _with(two, "SELECT market, playlist, position, _track_uri AS track_uri FROM lists_n")
    # tracks in both lists that are not on a longest increasing run (patience: each value takes the first pile top that is not smaller)
    q["playlist_edits"] = _with(two + [
        """common AS (SELECT market, playlist, list(o.position ORDER BY n.position) AS v
                      FROM lists_n n JOIN lists_o o USING (market, playlist, _track_uri) GROUP BY 1, 2)""",
        """piles AS (SELECT market, playlist, len(v) AS n, len(list_reduce(
                         list_prepend(CAST([] AS INTEGER[]), list_transform(v, lambda x: [CAST(x AS INTEGER)])),
                         lambda t, x: list_filter(t, lambda y: y < x[1]) || x || list_filter(t, lambda y: y >= x[1])[2:])) AS run FROM common)""",
        """sizes AS (SELECT market, playlist, sum(o) AS o, sum(n) AS n FROM (
                         SELECT market, playlist, 1 AS o, 0 AS n FROM lists_o UNION ALL SELECT market, playlist, 0, 1 FROM lists_n) GROUP BY 1, 2)"""], """
        SELECT market, playlist, CAST(s.o - coalesce(p.n, 0) AS BIGINT) AS n_remove, CAST(coalesce(p.n - p.run, 0) AS BIGINT) AS n_move,
               CAST(s.n - coalesce(p.n, 0) AS BIGINT) AS n_add
        FROM sizes s LEFT JOIN piles p USING (market, playlist)""")
    q["published_lists"] = _with(
        fx + chart_ctes(s="_o", day="1999-01-01") + playlist_ctes(s="_o") + chart_ctes(s="_n") + playlist_ctes(s="_n", names=("top",)), """
        SELECT market, playlist, position, _track_uri AS track_uri, '1999-01-01' AS as_of FROM lists_o WHERE playlist <> 'top'
        UNION ALL SELECT market, playlist, position, _track_uri, '2000-01-01' FROM lists_n""")
    q["load_once"] = _with(ch, """
        SELECT market, track_isrc, segment_name, _track_uri, _track_artist, substr('Żółć ' || _track_name, 1, 3) AS _track_name,
               _primary_genre, segment_streams, total_streams, feed FROM tracks""")
    q["best_cover_rolling"] = _with(fx + [
        """per AS (SELECT d.d, track_isrc, track_uri, sum(num_streams) AS streams
                   FROM (SELECT make_date(CAST(y AS BIGINT), 1, 1) AS d FROM generate_series(1995, 2001) t(y)) d
                   JOIN fs_all f ON f.report_date BETWEEN d.d - 730 AND d.d AND country_code = 'EUROPE' AND source_type_key IN (4, 7)
                   JOIN dpi USING (partner_info_key) GROUP BY 1, 2, 3)""",
        """best AS (SELECT *, row_number() OVER (PARTITION BY d, track_isrc ORDER BY streams DESC NULLS FIRST, track_uri NULLS LAST) AS k FROM per)"""], """
        SELECT strftime(d, '%Y-%m-%d') AS run_date, track_isrc, track_uri AS track_uri_fs, CAST(streams AS BIGINT) AS cover_streams
        FROM best WHERE k = 1""")
    q["segment_pivot"] = _with(ch, """
        SELECT * FROM (PIVOT (SELECT market, track_isrc, segment_name, segment_streams FROM tracks WHERE segment_name IS NOT NULL)
                       ON segment_name USING CAST(sum(segment_streams) AS BIGINT) GROUP BY market, track_isrc)
        UNION ALL BY NAME
        SELECT market, track_isrc FROM tracks GROUP BY 1, 2 HAVING count(segment_name) = 0""")
    q["statement_table"] = _with(ch, """
        SELECT market, track_isrc, segment_name, segment_streams FROM tracks WHERE feed = 'SME' AND segment_streams >= 20""")
    q["whole_inventory"] = _with(fx, """
        SELECT '' AS path, 'folder' AS kind, count(DISTINCT country_code) + 1 AS n, CAST(NULL AS BIGINT) AS bytes, count(DISTINCT country_code) + 1 AS n_times FROM scs
        UNION ALL SELECT '', 'hidden', 1, 0, 1
        UNION ALL
        SELECT '/market=' || country_code, 'data', 1,
               CAST(sum(strlen(CAST(consumer_key AS VARCHAR)) + coalesce(strlen(segment_name) + 1, 0) + 1) AS BIGINT), 1
        FROM scs GROUP BY country_code""")
    q["batch_replay"] = q["playlist_items"]
    q["playlist_pages"] = q["playlist_items"]
    q["segment_streams_colocated"] = q["segment_streams_sme"]
    q["parsed_timestamps"] = """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS compact, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS epoch, CAST(NULL AS VARCHAR) AS "none" FROM events"""
    return q
