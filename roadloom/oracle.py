"""The queries again as DuckDB SQL, written from their definitions.

Where the Spark plan avoids pairs (decomposed sums, leading-token joins), the
SQL compares every pair, so the two can only agree if the plan is right.
"""

from __future__ import annotations

from roadloom import catalog
from roadloom.functions import tuning
from roadloom.functions.hashing import MODULUS, hash_family


def _params(size: int, seed: int) -> str:
    rows = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(hash_family(size, seed)))
    return f"SELECT * FROM (VALUES {rows}) v(i, a, b)"


def _shingles(k: int) -> str:
    return f"""SELECT DISTINCT rid, array_to_string(list_slice(nodes, i, i + {k - 1}), ',') shingle
        FROM (SELECT rid, nodes, unnest(range(1, len(nodes) - {k - 2})) i FROM routes)"""


def _features(k: int) -> str:
    return f"""SELECT r.rid, r.driver, r.sroute, coalesce(s.n, 0) n, coalesce(s.sh, []) sh, m.w, m.q, m.mk
        FROM routes r
        LEFT JOIN (SELECT rid, count(*)::INTEGER n, list_sort(list(shingle)) sh FROM sh{k} GROUP BY rid) s USING (rid)
        JOIN (SELECT rid, sum(qty)::BIGINT w, sum(qty * qty)::BIGINT q, list_sort(list(item || '=' || qty)) mk
              FROM merch GROUP BY rid) m USING (rid)"""


def _token(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 15))::BIGINT % {MODULUS})"


def _signatures(source: str, params: str) -> str:
    return f"""SELECT rid, i, min((a * tok + b) % {MODULUS}) v
        FROM (SELECT rid, {source}), {params} GROUP BY rid, i"""


def _bands(signatures: str, threshold: float) -> str:
    bands, rows = tuning.bands_and_rows(catalog.SIGNATURE, threshold)
    return f"""SELECT rid, i // {rows} band, string_agg(v::VARCHAR, ',' ORDER BY i) key
        FROM {signatures} GROUP BY rid, i // {rows}"""


def _standard_pairs(k: int) -> str:
    """Driven x planned routes that share a shingle or an item, with all sums."""
    return f"""SELECT rid, std_no, coalesce(x.inter, 0) inter, coalesce(y.smin, 0) smin, coalesce(y.dot, 0) dot,
            a.n na, b.n nb, a.w wa, b.w wb, a.q qa, b.q qb, a.driver, a.sroute
        FROM (SELECT a.rid, b.rid std_no, count(*) inter FROM sh{k} a JOIN sh{k} b USING (shingle)
              WHERE b.rid IN (SELECT std_no FROM stds) GROUP BY ALL) x
        FULL JOIN (SELECT a.rid, b.rid std_no, sum(least(a.qty, b.qty))::BIGINT smin, sum(a.qty * b.qty)::BIGINT dot
              FROM merch a JOIN merch b USING (item)
              WHERE b.rid IN (SELECT std_no FROM stds) GROUP BY ALL) y USING (rid, std_no)
        JOIN f{k} a USING (rid) JOIN f{k} b ON b.rid = std_no"""


JAC = "coalesce(inter / nullif(na + nb - inter, 0), 0)"
RUZ = "coalesce(smin / nullif(wa + wb - smin, 0), 0)"
COS = "coalesce(dot / nullif(sqrt(qa) * sqrt(qb), 0), 0)"
L2 = "sqrt(qa + qb - 2 * dot)"
SIM = f"(0.5 * {JAC} + 0.5 * {RUZ})"

_DUPES = "round(sim, 9) DESC, std_no"

# name -> (CTEs it needs, text)
CTES: dict[str, tuple[str, str]] = {
    "legs": ("", """SELECT rid, driver, sroute, pos, f,
            coalesce(lead(f) OVER (PARTITION BY rid ORDER BY pos), sroute) t, item, qty FROM (
        SELECT l_orderkey rid, o_custkey driver, cn.n_name sroute, sn.n_name f, p_brand item, l_quantity::BIGINT qty,
            row_number() OVER (PARTITION BY l_orderkey
                ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) pos
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
        JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey)"""),
    "routes": ("legs", """SELECT rid, any_value(driver) driver, any_value(sroute) sroute, count(*)::INTEGER trips,
            list_append(list(f ORDER BY pos), arg_max(t, pos)) nodes FROM legs GROUP BY rid"""),
    "stds": ("routes", """SELECT rid std_no, sroute, trips, nodes FROM routes
            QUALIFY row_number() OVER (PARTITION BY sroute ORDER BY trips DESC, rid) = 1"""),
    "merch": ("legs", "SELECT rid, item, sum(qty)::BIGINT qty FROM legs GROUP BY rid, item"),
    "sh2": ("routes", _shingles(2)),
    "sh3": ("routes", _shingles(3)),
    "f2": ("routes sh2 merch", _features(2)),
    "f3": ("routes sh3 merch", _features(3)),
    "sp2": ("f2 sh2 merch stds", _standard_pairs(2)),
    "sp3": ("f3 sh3 merch stds", _standard_pairs(3)),
    "sims": ("sp3", f"SELECT *, {SIM} sim FROM sp3"),
    "best": ("sims", f"""SELECT rid, driver, sroute, std_no, sim FROM sims WHERE sim > 0
            QUALIFY row_number() OVER (PARTITION BY rid ORDER BY {_DUPES}) = 1"""),
    "voted": ("best", "SELECT driver, std_no, count(*) votes, sum(sim) score FROM best GROUP BY ALL"),
    "padded": ("voted routes stds", """SELECT d.driver, s.std_no, coalesce(score, 0.0) score
            FROM (SELECT DISTINCT driver FROM routes) d CROSS JOIN stds s
            LEFT JOIN voted v ON v.driver = d.driver AND v.std_no = s.std_no"""),
    "own": ("sims stds", """SELECT rid, std_no, 1 - sim dist FROM sims JOIN stds USING (std_no, sroute)
            WHERE sim > 0"""),
    "std_costs": ("own stds", """SELECT std_no, coalesce(avg(dist), 1.0) mean_dist
            FROM stds LEFT JOIN own USING (std_no) GROUP BY std_no"""),
    "dforms": ("f2", """SELECT driver, min(rid) form, count(*) weight, any_value(n) n, any_value(w) w, any_value(q) q
            FROM f2 GROUP BY driver, sh, mk"""),
    "dsh": ("dforms sh2", "SELECT driver, form, shingle FROM dforms JOIN sh2 ON form = rid"),
    "dmerch": ("dforms merch", "SELECT driver, form, item, qty FROM dforms JOIN merch ON form = rid"),
    "dix": ("dsh", """SELECT a.driver, a.form a, b.form b, count(*)::INTEGER inter
            FROM dsh a JOIN dsh b ON a.driver = b.driver AND a.shingle = b.shingle AND a.form < b.form GROUP BY ALL"""),
    "dmx": ("dmerch", """SELECT a.driver, a.form a, b.form b, sum(least(a.qty, b.qty))::BIGINT smin,
            sum(a.qty * b.qty)::BIGINT dot
            FROM dmerch a JOIN dmerch b ON a.driver = b.driver AND a.item = b.item AND a.form < b.form GROUP BY ALL"""),
    "dpairs": ("dix dmx dforms", f"""SELECT p.driver, p.a, p.b, p.inter, coalesce(smin, 0) smin, coalesce(dot, 0) dot,
            x.n na, y.n nb, x.w wa, y.w wb, x.q qa, y.q qb
            FROM (SELECT driver, a, b, coalesce(inter, 0) inter, smin, dot FROM dix FULL JOIN dmx USING (driver, a, b)) p
            JOIN dforms x ON x.form = a JOIN dforms y ON y.form = b"""),
    "allpairs": ("dforms dix dmx", """SELECT x.driver, x.form a, y.form b, coalesce(inter, 0) inter, coalesce(smin, 0) smin, coalesce(dot, 0) dot,
            x.n na, y.n nb, x.w wa, y.w wb, x.q qa, y.q qb FROM dforms x JOIN dforms y ON x.driver = y.driver AND x.form < y.form
            LEFT JOIN dix i ON i.a = x.form AND i.b = y.form LEFT JOIN dmx m ON m.a = x.form AND m.b = y.form"""),
    "jpairs": ("dpairs", f"SELECT * FROM dpairs WHERE {JAC} >= {catalog.JACCARD_MIN} - 1e-9"),
    "dedges": ("dpairs", f"""SELECT driver, a, b, 0.5 * (1 - {JAC}) + 0.5 * (1 - {RUZ}) d FROM dpairs
            WHERE 0.5 * (1 - {JAC}) + 0.5 * (1 - {RUZ}) <= {catalog.REACH} + 1e-9"""),
    "params": ("", _params(catalog.SIGNATURE, 17)),
    "mparams": ("", _params(catalog.MERCH_SIGNATURE, 29)),
    "sig2": ("sh2 params", _signatures(f"{_token('shingle')} tok FROM sh2", "params")),
    "sig3": ("sh3 params", _signatures(f"{_token('shingle')} tok FROM sh3", "params")),
    "units": ("merch", "SELECT rid, unnest(range(1, qty + 1)) j, item FROM merch"),
    "msig": ("units mparams", _signatures(_token("item || '#' || j") + " tok FROM units", "mparams")),
    "sforms": ("f2", "SELECT min(rid) form, count(*) weight, any_value(n) n FROM f2 GROUP BY sh"),
    "bandstd": ("sig2", _bands("sig2", catalog.STANDARD_LSH_THRESHOLD)),
}


def _lsh_limit(threshold: float) -> tuple[int, float]:
    bands, rows = tuning.bands_and_rows(catalog.SIGNATURE, threshold)
    return bands, tuning.share_threshold(bands, rows)


B2, LIMIT2 = _lsh_limit(catalog.STANDARD_LSH_THRESHOLD)
SIZE = catalog.SIGNATURE


BANDS, LIMIT = _lsh_limit(catalog.LSH_THRESHOLD)
CTES["bandsets"] = ("sig2 sforms", f"""SELECT rid, i // {SIZE // BANDS} band, string_agg(v::VARCHAR, ',' ORDER BY i) key
    FROM sig2 WHERE rid IN (SELECT form FROM sforms) GROUP BY rid, i // {SIZE // BANDS}""")
CTES["lsh"] = ("bandsets", f"""SELECT a.rid a, b.rid b, count(*) / {BANDS} share
    FROM bandsets a JOIN bandsets b ON a.band = b.band AND a.key = b.key AND a.rid < b.rid
    GROUP BY a.rid, b.rid HAVING count(*) / {BANDS} >= {LIMIT!r}""")
CTES["lshstd"] = ("bandstd stds", f"""SELECT a.rid, b.rid std_no, count(*) / {B2} share
    FROM bandstd a JOIN bandstd b ON a.band = b.band AND a.key = b.key
    WHERE b.rid IN (SELECT std_no FROM stds) GROUP BY ALL HAVING count(*) / {B2} >= {LIMIT2!r}""")
CTES["lshsims"] = ("lshstd sig2 sp2 routes", f"""SELECT l.rid, r.driver, l.std_no,
        0.5 * e.hits / {SIZE} + 0.5 * coalesce(smin / nullif(wa + wb - smin, 0), 0) sim
    FROM lshstd l JOIN routes r USING (rid)
    JOIN (SELECT a.rid, b.rid std_no, count(*) hits FROM sig2 a JOIN sig2 b ON a.i = b.i AND a.v = b.v
          WHERE b.rid IN (SELECT std_no FROM stds) GROUP BY ALL) e USING (rid, std_no)
    JOIN sp2 USING (rid, std_no)""")
CTES["pv"] = ("legs", """SELECT rid, 'p:' || f || ',' || t feature, 1.0::DOUBLE x FROM (SELECT DISTINCT rid, f, t FROM legs)
    UNION ALL SELECT rid, 'i:' || item, sum(qty) / sum(sum(qty)) OVER (PARTITION BY rid) FROM legs GROUP BY rid, item""")
CTES["pvq"] = ("pv routes", """SELECT rid, driver, sroute, feature, x / sqrt(sum(x * x) OVER (PARTITION BY rid)) u
    FROM pv JOIN routes USING (rid)""")
CTES["pcos"] = ("pvq", """SELECT a.driver, a.sroute, a.rid a, b.rid b, sum(a.u * b.u) c
    FROM pvq a JOIN pvq b ON a.driver = b.driver AND a.sroute = b.sroute AND a.feature = b.feature GROUP BY ALL""")
CTES["pmass"] = ("pcos routes", """SELECT driver, sroute, CASE WHEN n > 1 THEN (coalesce(c, 0) - n) / 2 ELSE 0 END mass
    FROM (SELECT driver, sroute, count(*) n FROM routes GROUP BY ALL)
    LEFT JOIN (SELECT driver, sroute, sum(c) c FROM pcos GROUP BY ALL) USING (driver, sroute)""")
CTES["pdom"] = ("pmass", """SELECT driver, sroute, mass FROM pmass
    QUALIFY row_number() OVER (PARTITION BY driver ORDER BY round(mass, 9) DESC, sroute) = 1""")
CTES["psum"] = ("pdom pcos routes", """SELECT driver, sroute, rid, n - coalesce(c, 0) sum_d
    FROM pdom JOIN routes USING (driver, sroute)
    JOIN (SELECT driver, sroute, count(*) n FROM routes GROUP BY ALL) USING (driver, sroute)
    LEFT JOIN (SELECT a rid, sum(c) c FROM pcos GROUP BY a) USING (rid)""")


def _group_distance(name: str, group: str, metric: str, pairs: bool = True) -> None:
    """Summed fused distance to every member of the group.

    Drivers are small, so there each part adds up joined pairs. The planned
    routes' groups are too large for that in one process and use group totals.
    """
    signed = f"(SELECT rid, {group} g, i, v FROM sig2 JOIN routes USING (rid))"
    if metric == "jaccard":
        needs = "routes sig2 msig"
        keyed = f"(SELECT rid, {group} g, i, v FROM msig JOIN routes USING (rid))"
        merch = f"""SELECT x.rid, count(*) / {catalog.MERCH_SIGNATURE} s
            FROM {keyed} x JOIN {keyed} y ON x.g = y.g AND x.i = y.i AND x.v = y.v GROUP BY x.rid"""
        value = "coalesce(m.s, 0)"
    else:
        needs = "routes sig2 merch f2"
        keyed = f"(SELECT rid, {group} g, item, qty, q FROM merch JOIN f2 USING (rid))"
        merch = f"""SELECT x.rid, sum(x.qty * y.qty / (sqrt(x.q) * sqrt(y.q))) s
            FROM {keyed} x JOIN {keyed} y ON x.g = y.g AND x.item = y.item GROUP BY x.rid"""
        value = "(coalesce(m.s, 0) + members) / 2"
    CTES[name] = (needs, f"""SELECT {group}, rid, members,
            0.5 * (members - coalesce(r.s, 0)) + 0.5 * (members - {value}) sum_d
        FROM routes JOIN (SELECT {group}, count(*) members FROM routes GROUP BY {group}) USING ({group})
        LEFT JOIN (SELECT x.rid, count(*) / {SIZE} s
            FROM {signed} x JOIN {signed} y ON x.g = y.g AND x.i = y.i AND x.v = y.v GROUP BY x.rid) r USING (rid)
        LEFT JOIN ({merch}) m USING (rid)""")
    if not pairs:
        merch = f"""SELECT x.rid, sum(x.qty / sqrt(x.q) * y.u) s FROM {keyed} x
            JOIN (SELECT g, item, sum(qty / sqrt(q)) u FROM {keyed} GROUP BY g, item) y USING (g, item) GROUP BY x.rid"""
        CTES[name] = (needs, f"""SELECT {group}, rid, members,
                0.5 * (members - coalesce(r.s, 0)) + 0.5 * (members - {value}) sum_d
            FROM routes JOIN (SELECT {group}, count(*) members FROM routes GROUP BY {group}) USING ({group})
            LEFT JOIN (SELECT x.rid, sum(y.c) / {SIZE} s FROM {signed} x
                JOIN (SELECT g, i, v, count(*) c FROM {signed} GROUP BY g, i, v) y USING (g, i, v) GROUP BY x.rid) r USING (rid)
            LEFT JOIN ({merch}) m USING (rid)""")


_group_distance("dsum_cos", "driver", "cosine")
_group_distance("dsum_jac", "driver", "jaccard")
_group_distance("ssum_cos", "sroute", "cosine", pairs=False)

CTES["cities"] = ("routes", """SELECT value, row_number() OVER (ORDER BY value) code
    FROM (SELECT DISTINCT unnest(nodes) AS value FROM routes)""")
CTES["items"] = ("merch", """SELECT value, row_number() OVER (ORDER BY value) code
    FROM (SELECT DISTINCT item AS value FROM merch)""")
CTES["slots"] = ("legs cities items", """SELECT rid, ((pos - 1) * (2 + (SELECT count(*) FROM items)) + o)::INTEGER slot, v AS value
    FROM (SELECT rid, pos, 0 o, code v FROM legs JOIN cities ON f = value
          UNION ALL SELECT rid, pos, 1, code FROM legs JOIN cities ON t = value
          UNION ALL SELECT rid, pos, 1 + code, qty FROM legs JOIN items ON item = value)""")
CTES["slotq"] = ("slots", "SELECT rid, sum(value * value)::BIGINT q FROM slots GROUP BY rid")
CTES["poscos"] = ("slots slotq stds routes", """SELECT rid, driver, std_no, dot / (sqrt(x.q) * sqrt(y.q)) sim
    FROM (SELECT a.rid, b.rid std_no, sum(a.value * b.value) dot FROM slots a JOIN slots b USING (slot)
          WHERE b.rid IN (SELECT std_no FROM stds) GROUP BY ALL)
    JOIN slotq x USING (rid) JOIN slotq y ON y.rid = std_no JOIN routes USING (rid)""")
CTES["posu"] = ("slots slotq routes", "SELECT rid, sroute, slot, value / sqrt(q) u FROM slots JOIN slotq USING (rid) JOIN routes USING (rid)")
CTES["poscent"] = ("posu", "SELECT sroute, slot, sum(u) u FROM posu GROUP BY ALL")
CTES["possum"] = ("posu poscent routes", """SELECT sroute, rid, n - c sum_d, n FROM (SELECT sroute, rid, sum(p.u * z.u) c
    FROM posu p JOIN poscent z USING (sroute, slot) GROUP BY ALL)
    JOIN (SELECT sroute, count(*) n FROM routes GROUP BY sroute) USING (sroute)""")
CTES["audit"] = ("routes stds legs", """SELECT rid, driver, sroute, cr / ns cities_removed, ca / ns cities_added,
        (ni - both_) / ni items_removed, (na - both_) / ni items_added, diff / ni items_changed
    FROM (SELECT r.rid, r.driver, r.sroute, len(list_distinct(s.nodes)) ns,
            len(list_filter(list_distinct(s.nodes), lambda x: NOT list_contains(r.nodes, x))) cr,
            len(list_filter(list_distinct(r.nodes), lambda x: NOT list_contains(s.nodes, x))) ca
          FROM routes r JOIN stds s USING (sroute)) c
    JOIN (SELECT rid, any_value(na) na, any_value(ni) ni, count(sq) both_, count(CASE WHEN sq <> aq THEN 1 END) diff
          FROM (SELECT a.rid, a.aq, s.sq, count(*) OVER (PARTITION BY a.rid) na, ni
                FROM (SELECT rid, sroute, f || ',' || t || ',' || item k, sum(qty) aq FROM legs GROUP BY ALL) a
                JOIN (SELECT sroute, count(DISTINCT f || ',' || t || ',' || item) ni FROM legs
                      WHERE rid IN (SELECT std_no FROM stds) GROUP BY sroute) USING (sroute)
                LEFT JOIN (SELECT sroute, f || ',' || t || ',' || item k, sum(qty) sq FROM legs
                      WHERE rid IN (SELECT std_no FROM stds) GROUP BY ALL) s ON s.sroute = a.sroute AND s.k = a.k)
          GROUP BY rid) i USING (rid)""")
SHARES = ", ".join(f"round(avg({c}), 10) {c}" for c in
                   ("cities_removed", "cities_added", "items_removed", "items_added", "items_changed"))
AUDIT = ", ".join(f"round({c}, 10) {c}" for c in
                  ("cities_removed", "cities_added", "items_removed", "items_added", "items_changed"))
PAIR = "driver, a, b"
TOP = """SELECT driver, row_number() OVER (PARTITION BY driver ORDER BY round(score, 9) DESC, std_no)::INTEGER rank,
    std_no, round(score, 10) score FROM {} QUALIFY rank <= 5"""


def _top_from(metric: str, k: int) -> str:
    return f"""(SELECT driver, std_no, sum(sim) score FROM (
        SELECT rid, driver, std_no, {metric} sim FROM sp{k} WHERE {metric} > 0
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY round({metric}, 9) DESC, std_no) = 1)
        GROUP BY driver, std_no)"""


# name -> (CTEs it needs, statement)
STATEMENTS: dict[str, tuple[str, str]] = {
    "route_profile": ("routes stds legs merch", """SELECT (SELECT count(*) FROM routes) n_actual,
        (SELECT count(*) FROM stds) n_standard, max(trips) longest, min(trips) shortest,
        (SELECT max(s) FROM (SELECT sum(qty)::BIGINT s FROM legs GROUP BY rid, pos)) max_qty,
        count(DISTINCT driver) n_drivers, (SELECT count(DISTINCT c) FROM (SELECT unnest(nodes) c FROM routes)) n_cities,
        (SELECT count(DISTINCT item) FROM merch) n_items FROM routes"""),
    "route_shingles_k2": ("sh2", "SELECT rid, shingle FROM sh2"),
    "route_shingles_k3": ("sh3", "SELECT rid, shingle FROM sh3"),
    "shingle_vocab_size": ("sh3", "SELECT count(DISTINCT shingle) n_actual, count(DISTINCT shingle) n_both FROM sh3"),
    "route_merch": ("merch", "SELECT rid, item, qty FROM merch"),
    "route_merch_scaled": ("merch legs routes", """SELECT rid, item,
        round(qty / ((SELECT max(qty) FROM legs) * (SELECT max(trips) FROM routes)), 9) share FROM merch"""),
    "route_merch_own_length": ("merch legs routes", """SELECT rid, item,
        round(qty / ((SELECT max(qty) FROM legs) * trips), 9) share FROM merch JOIN routes USING (rid)"""),
    "city_codes": ("cities", "SELECT value, code FROM cities"),
    "item_codes": ("items", "SELECT value, code FROM items"),
    "city_pairs": ("cities", "SELECT a.value c1, b.value c2 FROM cities a, cities b WHERE a.value <> b.value"),
    "city_triples": ("cities", """SELECT a.value c1, b.value c2, c.value c3 FROM cities a, cities b, cities c
        WHERE a.value <> b.value AND b.value <> c.value AND a.value <> c.value"""),
    "city_permutations": ("cities", """SELECT n, n * (n - 1) p2, n * (n - 1) * (n - 2) p3, n * (n - 1) // 2 c2,
        n * (n - 1) * (n - 2) // 6 c3 FROM (SELECT count(*) n FROM cities)"""),
    "stacked_routes": ("routes stds", """SELECT rid, 1 "type", trips, array_to_string(nodes, '>') path FROM routes
        UNION ALL SELECT std_no, 0, trips, array_to_string(nodes, '>') FROM stds"""),
    "driver_codes": ("routes", """SELECT driver AS value, row_number() OVER (ORDER BY min(rid)) - 1 code
        FROM routes GROUP BY driver"""),
    "route_city_order": ("routes", """SELECT rid, string_agg(c, '>' ORDER BY i) cities FROM (
        SELECT rid, c, min(i) i FROM (SELECT rid, unnest(nodes) c, unnest(range(len(nodes))) i FROM routes)
        GROUP BY rid, c) GROUP BY rid"""),
    "driver_forms": ("dforms", "SELECT driver, form, weight, n, w, q FROM dforms"),
    "driver_pairs_jaccard": ("jpairs", f"SELECT {PAIR}, inter, (na + nb - inter)::INTEGER union_n, {JAC} jaccard FROM jpairs"),
    "driver_pairs_ruzicka": ("dpairs", f"""SELECT {PAIR}, smin, round({RUZ}, 10) ruzicka FROM dpairs
        WHERE {RUZ} >= {catalog.RUZICKA_MIN} - 1e-9"""),
    "driver_pairs_cosine": ("dpairs", f"""SELECT {PAIR}, round({COS}, 10) cosine, round(({COS} + 1) / 2, 10) half_cosine
        FROM dpairs WHERE {COS} >= {catalog.COSINE_MIN} - 1e-9"""),
    "driver_pairs_l2": ("allpairs legs routes", f"""SELECT {PAIR}, round(d, 6) l2, round(1 / (1 + d), 6) l2_sim FROM (
        SELECT {PAIR}, {L2} / ((SELECT max(qty) FROM legs) * (SELECT max(trips) FROM routes)) d FROM allpairs)
        WHERE d <= {catalog.L2_MAX} + 1e-9"""),
    **{f"driver_pairs_fused_{name}": ("allpairs", f"""SELECT {PAIR}, round(d, 10) d FROM (SELECT {PAIR}, {d} d FROM allpairs)
        WHERE d <= {catalog.FUSED_MAX[key]} + 1e-9""") for name, key, d in (
        ("mean", ("mean", "jaccard"), f"0.5 * (1 - {JAC}) + 0.5 * (1 - {RUZ})"),
        ("product", ("product", "jaccard"), f"(1 - {JAC}) * (1 - {RUZ})"),
        ("wproduct", ("weighted product", "jaccard"), f"sqrt(1 - {JAC}) * sqrt(1 - {RUZ})"))},
    "driver_pairs_fused_mean_cosine": ("jpairs", f"""SELECT {PAIR},
        round(0.5 * (1 - {JAC}) + 0.5 * (1 - ({COS} + 1) / 2), 10) d FROM jpairs"""),
    "driver_edges": ("dedges", f"SELECT {PAIR}, round(d, 10) d FROM dedges"),
    "nan_scan": ("dedges", "SELECT count(*) pairs, count(CASE WHEN d IS NULL OR isnan(d) THEN 1 END) invalid FROM dedges"),
    "std_similarity": ("sims", f"""SELECT rid, std_no, inter, smin, dot, round({JAC}, 10) jaccard, round({RUZ}, 10) ruzicka,
        round({COS}, 10) cosine, round({L2}, 6) l2, round(sim, 10) sim FROM sims"""),
    "std_std_distance": ("sims", """SELECT rid a, std_no b, round(1 - sim, 10) d FROM sims
        WHERE rid IN (SELECT std_no FROM stds) AND rid < std_no"""),
    "best_standard": ("best", "SELECT rid, std_no, round(sim, 10) sim FROM best"),
    "driver_top5": ("padded", TOP.format("padded")),
    "driver_top5_voted": ("voted", TOP.format("voted")),
    "driver_top5_cosine": ("sp3", TOP.format(_top_from(f"(0.5 * {JAC} + 0.5 * ({COS} + 1) / 2)", 3))),
    "driver_top5_product": ("sp2", TOP.format(_top_from(f"({JAC} * {RUZ})", 2))),
    "driver_top5_maxsim": ("poscos", TOP.format("""(SELECT driver, std_no, max(sim) score FROM (SELECT * FROM poscos
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY round(sim, 9) DESC, std_no) = 1) GROUP BY driver, std_no)""")),
    "driver_score_ratio": ("padded sims voted routes stds", f"""SELECT rank, round(avg(ratio), 6) mean_ratio,
        round((1 - avg(ratio)) * 100, 4) improvement FROM (
        SELECT rank, CASE WHEN score = 0 THEN 0 ELSE coalesce(total, 0) / (SELECT count(*) FROM stds) / score END ratio
        FROM (SELECT driver, score, row_number() OVER (PARTITION BY driver ORDER BY round(score, 9) DESC, std_no)::INTEGER rank
              FROM padded QUALIFY rank <= 5)
        LEFT JOIN (SELECT driver, sum(s / n * votes) total
              FROM (SELECT driver, std_no, sum(sim) s FROM sims GROUP BY ALL) JOIN voted USING (driver, std_no)
              JOIN (SELECT driver, count(*) n FROM routes GROUP BY driver) USING (driver) GROUP BY driver) USING (driver))
        GROUP BY rank"""),
    "own_standard_distance": ("own", "SELECT rid, std_no, round(dist, 10) dist FROM own"),
    "standard_distance_report": ("std_costs", """SELECT round(avg(mean_dist), 6) mean, round(stddev_pop(mean_dist), 6) std,
        round(stddev_pop(mean_dist) / avg(mean_dist), 6) cv FROM std_costs"""),
    "driver_load": ("routes", """SELECT round(avg(n) / sum(n), 9) mean_share, round(stddev_pop(n) / sum(n), 9) std_share,
        round(min(n) / sum(n), 9) min_share, round(max(n) / sum(n), 9) max_share
        FROM (SELECT count(*) n FROM routes GROUP BY driver)"""),
    "driver_routes": ("routes", """SELECT driver, count(*) routes, count(DISTINCT sroute) standards,
        min(rid) first_route, max(rid) last_route FROM routes GROUP BY driver"""),
    "driver_standard_table": ("routes", "SELECT rid, driver, sroute FROM routes"),
    "route_preview": ("routes", "SELECT rid, driver, sroute, trips FROM routes ORDER BY rid LIMIT 5"),
    "divergence_audit": ("audit", f"SELECT rid, driver, sroute, {AUDIT} FROM audit"),
    "divergence_summary": ("audit", f"""SELECT driver, sroute, count(*) routes, {SHARES} FROM audit
        GROUP BY GROUPING SETS ((driver), (sroute), ())"""),
    "minhash_signatures": ("sig3", "SELECT rid, string_agg(v::VARCHAR, ',' ORDER BY i) signature FROM sig3 GROUP BY rid"),
    "merch_signatures": ("msig", "SELECT rid, string_agg(v::VARCHAR, ',' ORDER BY i) signature FROM msig GROUP BY rid"),
    "lsh_candidates": ("lsh", "SELECT a, b, share FROM lsh"),
    "signature_similarity": ("lsh sig2", f"""SELECT l.a, l.b, count(CASE WHEN x.v = y.v THEN 1 END) / {SIZE} estimate,
        round(sum(least(x.v, y.v)) / sum(greatest(x.v, y.v)), 6) sig_ruzicka
        FROM lsh l JOIN sig2 x ON x.rid = l.a JOIN sig2 y ON y.rid = l.b AND x.i = y.i GROUP BY l.a, l.b"""),
    "lsh_isolated": ("lsh sforms", """SELECT form, weight, n FROM sforms
        WHERE form NOT IN (SELECT a FROM lsh UNION ALL SELECT b FROM lsh)"""),
    "lsh_report": ("lsh sforms", """SELECT forms, (SELECT count(*) FROM (SELECT a FROM lsh UNION SELECT b FROM lsh)) linked,
        kept, forms * (forms - 1) // 2 total, round((1 - kept / (forms * (forms - 1) // 2)) * 100, 6) saved
        FROM (SELECT count(*) forms, (SELECT count(*) FROM lsh) kept FROM sforms)"""),
    "lsh_std_candidates": ("lshstd", "SELECT rid, std_no, share FROM lshstd"),
    "lsh_refined_top5": ("lshsims routes stds", TOP.format("""(SELECT d.driver, s.std_no, coalesce(score, 0.0) score
        FROM (SELECT DISTINCT driver FROM routes) d CROSS JOIN stds s LEFT JOIN (
            SELECT driver, std_no, sum(sim) score FROM (SELECT * FROM lshsims WHERE sim > 0
                QUALIFY row_number() OVER (PARTITION BY rid ORDER BY round(sim, 9) DESC, std_no) = 1) GROUP BY driver, std_no) v
        ON v.driver = d.driver AND v.std_no = s.std_no)""")),
    "pair_vectors": ("pv", "SELECT rid, feature, round(x, 9) value FROM pv"),
    "driver_dominant_standard": ("pdom", "SELECT driver, sroute, round(mass, 6) mass FROM pdom"),
    "driver_ideal_pairvec": ("psum", """SELECT driver, rid, sroute, round(sum_d, 6) sum_d FROM psum
        QUALIFY row_number() OVER (PARTITION BY driver ORDER BY round(sum_d, 9) DESC, rid DESC) = 1"""),
    "driver_ideal_pairvec_medoid": ("psum", """SELECT driver, rid, sroute, round(sum_d, 6) sum_d FROM psum
        QUALIFY row_number() OVER (PARTITION BY driver ORDER BY round(sum_d, 9), rid) = 1"""),
    "driver_mean_distance_cosine": ("dsum_cos", "SELECT driver, rid, round(sum_d / members, 10) mean_d FROM dsum_cos"),
    "driver_mean_distance_jaccard": ("dsum_jac", "SELECT driver, rid, round(sum_d / members, 10) mean_d FROM dsum_jac"),
    "driver_mean_distance_product": ("routes sig2 merch f2", f"""SELECT driver, a.rid,
        round(avg((1 - coalesce(s.s, 0)) * (1 - coalesce(c.c, 0)) / 2), 10) mean_d
        FROM (SELECT driver, rid FROM routes) a JOIN (SELECT driver, rid other FROM routes) b USING (driver)
        LEFT JOIN (SELECT x.rid, y.rid other, count(*) / {SIZE} s
            FROM (SELECT * FROM sig2 JOIN (SELECT rid, driver FROM routes) USING (rid)) x
            JOIN (SELECT * FROM sig2 JOIN (SELECT rid, driver FROM routes) USING (rid)) y
            ON x.driver = y.driver AND x.i = y.i AND x.v = y.v GROUP BY ALL) s ON s.rid = a.rid AND s.other = b.other
        LEFT JOIN (SELECT x.rid, y.rid other, sum(x.qty * y.qty / (sqrt(x.q) * sqrt(y.q))) c
            FROM (SELECT * FROM merch JOIN (SELECT rid, driver, q FROM f2) USING (rid)) x
            JOIN (SELECT * FROM merch JOIN (SELECT rid, driver, q FROM f2) USING (rid)) y
            ON x.driver = y.driver AND x.item = y.item GROUP BY ALL) c ON c.rid = a.rid AND c.other = b.other
        GROUP BY driver, a.rid"""),
    "running_divergence": ("dsum_cos", """SELECT round(avg(best), 6) mean_best, round(avg(mean), 6) mean_mean,
        round(avg(rb / rm), 6) running_ratio, round(avg(coalesce(round(best, 9) / nullif(round(mean, 9), 0), 0)), 6) driver_ratio,
        round((1 - avg(rb / rm)) * 100, 6) change FROM (
        SELECT best, mean, sum(best) OVER w rb, sum(mean) OVER w rm FROM (
            SELECT driver, min(sum_d / members) best, avg(sum_d / members) mean FROM dsum_cos GROUP BY driver)
        WINDOW w AS (ORDER BY driver ROWS UNBOUNDED PRECEDING))"""),
    "components": ("dforms dedges reach", "SELECT node AS form, min(c) component FROM reach GROUP BY node"),
    "medoid_by_sroute": ("ssum_cos", """SELECT sroute, rid, members, round(sum_d, 4) sum_d FROM ssum_cos
        QUALIFY row_number() OVER (PARTITION BY sroute ORDER BY round(sum_d, 9), rid) = 1"""),
    "medoid_standard_match": ("ssum_cos best", """SELECT count(*) medoids, count(DISTINCT std_no) plans,
        count(*) = count(DISTINCT std_no) one_to_one FROM (SELECT rid FROM ssum_cos
        QUALIFY row_number() OVER (PARTITION BY sroute ORDER BY round(sum_d, 9), rid) = 1) JOIN best USING (rid)"""),
    "positional_vectors": ("slots", "SELECT rid, slot, value FROM slots"),
    "decoded_routes": ("legs", "SELECT rid, (pos - 1)::INTEGER pos, f origin, t dest, item || '=' || qty AS load FROM legs"),
    "standard_spread": ("possum posu poscent stds", """SELECT sroute, rid, round(sum_d, 4) clustroid_d,
        round(n - c, 4) plan_d FROM (SELECT * FROM possum
            QUALIFY row_number() OVER (PARTITION BY sroute ORDER BY round(sum_d, 9), rid) = 1)
        JOIN (SELECT p.sroute, sum(p.u * z.u) c FROM posu p JOIN poscent z USING (sroute, slot)
              WHERE p.rid IN (SELECT std_no FROM stds) GROUP BY p.sroute) USING (sroute)"""),
    "standard_pair_spread": ("possum", """SELECT sroute, n, round(sum(sum_d) / (n * (n - 1)), 6) mean_dist
        FROM possum GROUP BY sroute, n"""),
    "nearest_center_by_sroute": ("slots stds routes", """SELECT std_no, label, round(dist, 6) dist FROM (
        SELECT std_no, label, sqrt(sum(power(coalesce(x, 0) - coalesce(m, 0), 2))) dist
        FROM (SELECT s.std_no, c.label, k.slot FROM stds s CROSS JOIN (SELECT DISTINCT sroute label FROM routes) c
              CROSS JOIN (SELECT DISTINCT slot FROM slots) k)
        LEFT JOIN (SELECT rid std_no, slot, value x FROM slots) USING (std_no, slot)
        LEFT JOIN (SELECT sroute label, slot, sum(value) / any_value(n) m FROM slots JOIN routes USING (rid)
              JOIN (SELECT sroute, count(*) n FROM routes GROUP BY sroute) USING (sroute) GROUP BY sroute, slot) USING (label, slot)
        GROUP BY std_no, label)
        QUALIFY row_number() OVER (PARTITION BY std_no ORDER BY round(dist, 9), label) = 1"""),
    "cluster_purity": ("routes", """SELECT sroute, round(sum(CASE WHEN n > 1 THEN n ELSE 0 END) / max(n), 10) purity
        FROM (SELECT sroute, trips, count(*) n FROM routes GROUP BY ALL) GROUP BY sroute"""),
}
CTES["reach"] = ("dforms dedges", """SELECT form node, form c FROM dforms
    UNION SELECT e.y, r.c FROM reach r JOIN (SELECT a x, b y FROM dedges UNION ALL SELECT b, a FROM dedges) e ON e.x = r.node""")
CTES["gforms"] = ("f2", """SELECT min(rid) form, count(*) weight, any_value(n) n, any_value(w) w FROM f2 GROUP BY sh, mk""")
CTES["gpairs"] = ("gforms sh2 merch", f"""SELECT coalesce(s.a, m.a) a, coalesce(s.b, m.b) b, coalesce(inter, 0) inter, coalesce(smin, 0) smin
    FROM (SELECT s.rid a, t.rid b, count(*) inter
          FROM (SELECT * FROM sh2 WHERE rid IN (SELECT form FROM gforms)) s
          JOIN (SELECT * FROM sh2 WHERE rid IN (SELECT form FROM gforms)) t
          ON s.shingle = t.shingle AND s.rid < t.rid GROUP BY ALL) s
    FULL JOIN (SELECT x.rid a, y.rid b, sum(least(x.qty, y.qty)) smin
          FROM (SELECT * FROM merch WHERE rid IN (SELECT form FROM gforms)) x
          JOIN (SELECT * FROM merch WHERE rid IN (SELECT form FROM gforms)) y
          ON x.item = y.item AND x.rid < y.rid GROUP BY ALL) m ON s.a = m.a AND s.b = m.b""")
CTES["gedges"] = ("gpairs", f"""SELECT a, b FROM (SELECT p.*, x.n na, y.n nb, x.w wa, y.w wb
        FROM gpairs p JOIN gforms x ON x.form = a JOIN gforms y ON y.form = b)
    WHERE 0.5 * (1 - {JAC}) + 0.5 * (1 - {RUZ}) <= {catalog.DBSCAN_EPS} + 1e-9""")
CTES["gboth"] = ("gedges", "SELECT a x, b y FROM gedges UNION ALL SELECT b, a FROM gedges")
CTES["gcore"] = ("gforms gboth", f"""SELECT form, weight + coalesce(near, 0) >= {catalog.DBSCAN_MIN} core FROM gforms
    LEFT JOIN (SELECT x form, sum(weight) near FROM gboth JOIN gforms ON form = y GROUP BY x) USING (form)""")
CTES["creach"] = ("gcore gboth", """SELECT form node, form c FROM gcore WHERE core
    UNION SELECT e.y, r.c FROM creach r JOIN gboth e ON e.x = r.node JOIN gcore k ON k.form = e.y AND k.core""")
CTES["clabel"] = ("creach", "SELECT node, min(c) label FROM creach GROUP BY node")
STATEMENTS["dbscan_routes"] = ("gcore clabel gboth", """SELECT form node, coalesce(own.label, edge.label, -1) AS label, core
    FROM gcore LEFT JOIN clabel own ON own.node = form
    LEFT JOIN (SELECT x, min(label) AS label FROM gboth JOIN clabel ON node = y GROUP BY x) edge ON edge.x = form""")

CTES["trips"] = ("dsum_cos routes", """SELECT d.driver, d.rid, r.trips AS label, d.sum_d / d.members AS mean_d, nodes
    FROM dsum_cos d JOIN routes r USING (rid)""")
CTES["tscore"] = ("trips", """SELECT driver, label, count(*) size, (1 - avg(mean_d)) * count(*) score FROM trips GROUP BY driver, label""")
CTES["tideal"] = ("trips tscore", """SELECT driver, rid, label, nodes, min(mean_d) OVER (PARTITION BY driver) best, avg(mean_d) OVER (PARTITION BY driver) mean
    FROM trips JOIN (SELECT driver, label FROM tscore
        QUALIFY row_number() OVER (PARTITION BY driver ORDER BY round(score, 9), label) = 1) USING (driver, label)
    QUALIFY row_number() OVER (PARTITION BY driver ORDER BY round(mean_d, 9), rid) = 1""")
CTES["pmedoid"] = ("ssum_cos stds routes", """SELECT std_no AS label, rid, members, sum_d / members AS mean_d, r.nodes
    FROM ssum_cos s JOIN stds USING (sroute) JOIN (SELECT rid, nodes FROM routes) r USING (rid)
    QUALIFY row_number() OVER (PARTITION BY sroute ORDER BY round(sum_d, 9), rid) = 1""")
STATEMENTS |= {
    "cluster_scores_by_trips": ("tscore", "SELECT driver, label, size, round(score, 6) score FROM tscore"),
    "ideal_by_trips": ("tideal", """SELECT driver, rid, label, round(best, 6) best, round(mean, 6) mean,
        array_to_string(nodes, '>') path FROM tideal"""),
    "recommended_by_plan": ("pmedoid", """SELECT row_number() OVER (ORDER BY label) - 1 new_no, rid, label,
        round(mean_d, 6) mean_d, array_to_string(nodes, '>') path FROM pmedoid"""),
    "improvement_by_plan": ("pmedoid std_costs", """SELECT measure, round(c, 6) clusters, round(s, 6) standards, round(c / s * 100 - 100, 6) change FROM (
        SELECT 'mean' measure, (SELECT avg(mean_d) FROM pmedoid) c, (SELECT avg(mean_dist) FROM std_costs) s
        UNION ALL SELECT 'std', (SELECT stddev_pop(mean_d) FROM pmedoid), (SELECT stddev_pop(mean_dist) FROM std_costs)
        UNION ALL SELECT 'cv', (SELECT stddev_pop(mean_d) / avg(mean_d) FROM pmedoid), (SELECT stddev_pop(mean_dist) / avg(mean_dist) FROM std_costs))"""),
    "cluster_sizes_by_plan": ("routes stds", "SELECT std_no AS label, count(*) size FROM routes JOIN stds USING (sroute) GROUP BY std_no"),
    "medoids_in_plan_order": ("pmedoid best", """SELECT row_number() OVER (ORDER BY std_no) - 1 new_no, std_no, rid, label FROM (
        SELECT b.std_no, p.rid, p.label FROM pmedoid p JOIN best b USING (rid)
        QUALIFY row_number() OVER (PARTITION BY b.std_no ORDER BY members DESC, rid) = 1)"""),
    "written_plans": ("stds", "SELECT std_no, 's' || std_no AS sroute, trips, array_to_string(nodes, '>') path FROM stds"),
    "written_top5": ("padded", "SELECT driver, rank, std_no FROM (" + TOP.format("padded") + ")"),
    "written_ideal": ("tideal", """SELECT driver::VARCHAR driver, (len(nodes) - 1)::INTEGER trips, array_to_string(nodes, '>') path FROM tideal"""),
}


CTES |= {
    "pforms": ("slots", """SELECT min(rid) form, count(*) weight FROM (
        SELECT rid, list(slot || '=' || value ORDER BY slot) content FROM slots GROUP BY rid) GROUP BY content"""),
    "pvec": ("pforms posu", """SELECT form, any_value(weight) weight, list(coalesce(u, 0.0) ORDER BY slot) v
        FROM (SELECT form, weight, slot FROM pforms CROSS JOIN (SELECT DISTINCT slot FROM posu))
        LEFT JOIN (SELECT rid form, slot, u FROM posu) USING (form, slot) GROUP BY form"""),
    "pedges": ("pvec", f"""SELECT x.form a, y.form b FROM pvec x JOIN pvec y ON x.form < y.form
        WHERE list_dot_product(x.v, y.v) >= 1 - {catalog.POSITIONAL_EPS} - 1e-9"""),
    "pboth": ("pedges", "SELECT a x, b y FROM pedges UNION ALL SELECT b, a FROM pedges"),
    "pcore": ("pforms pboth routes stds", """SELECT form, weight + coalesce(near, 0) >= (SELECT count(*) FROM routes) // (SELECT count(*) FROM stds) // 2 core
        FROM pforms LEFT JOIN (SELECT x form, sum(weight) near FROM pboth JOIN pforms ON form = y GROUP BY x) USING (form)"""),
    "preach": ("pcore pboth", """SELECT form node, form c FROM pcore WHERE core
        UNION SELECT e.y, r.c FROM preach r JOIN pboth e ON e.x = r.node JOIN pcore k ON k.form = e.y AND k.core"""),
    "plabel": ("preach", "SELECT node, min(c) label FROM preach GROUP BY node"),
}
STATEMENTS["positional_dbscan"] = ("pcore plabel pboth", """SELECT form node, coalesce(own.label, edge.label, -1) AS label, core
    FROM pcore LEFT JOIN plabel own ON own.node = form
    LEFT JOIN (SELECT x, min(label) AS label FROM pboth JOIN plabel ON node = y GROUP BY x) edge ON edge.x = form""")


# --- the density hierarchy: parts of the graph at every distance of a driver ------------------------
CTES |= {
    "hn": ("dforms dedges", """SELECT driver, form x, weight w, greatest(CASE WHEN weight >= 2 THEN 0 ELSE d END, 1e-6) c FROM dforms
        LEFT JOIN (SELECT f, min(d) d FROM (SELECT a f, d FROM dedges UNION ALL SELECT b, d FROM dedges) GROUP BY f) ON f = form
        WHERE weight >= 2 OR d IS NOT NULL"""),
    "hm": ("hn dedges", """SELECT e.driver, a, b, greatest(e.d, p.c, q.c) d FROM dedges e JOIN hn p ON p.x = a JOIN hn q ON q.x = b"""),
    "hl": ("hn hm", "SELECT driver, d t FROM hm UNION SELECT driver, c FROM hn WHERE w >= 2"),
    "hreach": ("hn hm hl", """SELECT l.driver, l.t, n.x, n.x y FROM hl l JOIN hn n USING (driver)
        WHERE (n.w >= 2 AND n.c <= l.t) OR n.x IN (SELECT a FROM hm WHERE d <= l.t AND a = n.x) OR n.x IN (SELECT b FROM hm WHERE d <= l.t AND b = n.x)
        UNION SELECT r.driver, r.t, r.x, e.y FROM hreach r
        JOIN (SELECT a x, b y, d FROM hm UNION ALL SELECT b, a, d FROM hm) e ON e.x = r.y AND e.d <= r.t"""),
    "hpart": ("hreach", "SELECT driver, t, x, min(y) part FROM hreach GROUP BY ALL"),
    "hbig": ("hpart hn", """SELECT driver, t, part, x, w FROM (
        SELECT p.driver, t, part, p.x, w, sum(w) OVER (PARTITION BY p.driver, t, part) size FROM hpart p JOIN hn USING (driver, x)) WHERE size >= 2"""),
    "hlag": ("hl", "SELECT driver, t, lag(t) OVER (PARTITION BY driver ORDER BY t) before FROM hl"),
    "hkids": ("hbig hlag", """SELECT b.driver, b.t, b.part, sum(b.w) size, count(DISTINCT o.part) kids FROM hbig b JOIN hlag USING (driver, t)
        LEFT JOIN hbig o ON o.driver = b.driver AND o.t = before AND o.x = b.x GROUP BY ALL"""),
    "hseen": ("hbig hkids", """SELECT b.driver, b.t, b.part, b.x, b.w,
        max(CASE WHEN kids <> 1 THEN b.t END) OVER (PARTITION BY b.driver, b.x ORDER BY b.t) born FROM hbig b JOIN hkids USING (driver, t, part)"""),
    "hborn": ("hseen", "SELECT driver, t, part, max(born) born FROM hseen GROUP BY ALL"),
    "hof": ("hseen hborn", """SELECT s.driver, s.t, s.x, s.w, h.born, min(o.part) name FROM hseen s JOIN hborn h USING (driver, t, part)
        JOIN hseen p ON p.driver = s.driver AND p.t = s.t AND p.part = s.part JOIN hseen o ON o.driver = p.driver AND o.t = h.born AND o.x = p.x
        GROUP BY ALL"""),
    "hhome": ("hof", "SELECT * FROM hof QUALIFY row_number() OVER (PARTITION BY driver, x ORDER BY t) = 1"),
    "hsize": ("hkids hhome", """SELECT k.driver, k.t born, k.part name, any_value(k.size) + coalesce(sum(h.w), 0) size,
        any_value(k.size) / k.t + coalesce(sum(h.w / h.t), 0) gained FROM hkids k
        LEFT JOIN hhome h ON h.driver = k.driver AND h.born = k.t AND h.name = k.part AND h.t > k.t WHERE kids <> 1 GROUP BY k.driver, k.t, k.part"""),
    "hup": ("hkids hbig hlag hof", """SELECT DISTINCT k.driver, o.born, o.name, k.t pborn, k.part pname FROM hkids k
        JOIN hbig b ON b.driver = k.driver AND b.t = k.t AND b.part = k.part JOIN hlag l ON l.driver = k.driver AND l.t = k.t
        JOIN hof o ON o.driver = k.driver AND o.t = l.before AND o.x = b.x WHERE kids > 1"""),
    "hclusters": ("hsize hup", """SELECT *, gained - size / coalesce(pborn, 1.0) s, row_number() OVER (PARTITION BY driver ORDER BY born, name) i,
        pborn IS NULL AND count(*) FILTER (pborn IS NULL) OVER (PARTITION BY driver) = 1 root
        FROM hsize LEFT JOIN hup USING (driver, born, name)"""),
    "hbelow": ("hclusters", """SELECT c.driver, c.i, any_value(c.s) s, any_value(c.size) size, any_value(c.root) root,
        coalesce(list(k.i) FILTER (k.i IS NOT NULL), []) kids FROM hclusters c
        LEFT JOIN hclusters k ON k.driver = c.driver AND k.pborn = c.born AND k.pname = c.name GROUP BY c.driver, c.i"""),
    "hstep": ("hbelow routes stds", """SELECT driver, 0::BIGINT i, []::DOUBLE[] best, []::BOOLEAN[] keep FROM (SELECT DISTINCT driver FROM hbelow)
        UNION ALL SELECT driver, i, list_append(best, CASE WHEN ok THEN s ELSE inner_ END), list_append(keep, ok) FROM (
            SELECT *, NOT root AND size <= (SELECT count(*) FROM routes) // (SELECT count(*) FROM stds) AND s >= inner_ * (1 - 1e-12) ok FROM (
                SELECT r.driver, b.i, r.best, r.keep, b.s, b.size, b.root, coalesce(list_sum(list_transform(b.kids, lambda k: r.best[k])), 0) inner_
                FROM hstep r JOIN hbelow b ON b.driver = r.driver AND b.i = r.i + 1))"""),
    "hkept": ("hstep hclusters", """SELECT c.*, f.keep[c.i] keep FROM hclusters c
        JOIN (SELECT driver, arg_max(keep, i) keep FROM hstep GROUP BY driver) f USING (driver)"""),
    "hwalk": ("hhome hkept", """SELECT h.x, k.driver, k.born, k.name, k.keep, k.pborn, k.pname FROM hhome h JOIN hkept k ON k.driver = h.driver AND k.born = h.born AND k.name = h.name
        UNION ALL SELECT w.x, k.driver, k.born, k.name, k.keep, k.pborn, k.pname FROM hwalk w JOIN hkept k ON k.driver = w.driver AND k.born = w.pborn AND k.name = w.pname"""),
    "hlabel": ("hwalk f2 dforms", """SELECT f.rid, f.driver, coalesce(l.label, -1) AS label
        FROM f2 f JOIN (SELECT d.driver, d.form, g.sh, g.mk FROM dforms d JOIN f2 g ON g.rid = d.form) d
        ON d.driver = f.driver AND d.sh = f.sh AND d.mk = f.mk
        LEFT JOIN (SELECT x, arg_max(name, born) AS label FROM hwalk WHERE keep GROUP BY x) l ON l.x = d.form"""),
    "iscore": ("hlabel dsum_jac", """SELECT driver, label, count(*) size, (1 - avg(sum_d / members)) * count(*) score
        FROM hlabel JOIN dsum_jac USING (driver, rid) WHERE label >= 0 GROUP BY driver, label"""),
}
STATEMENTS["density_labels_driver"] = ("hlabel", "SELECT rid, driver, label FROM hlabel")
STATEMENTS["ideal_route"] = ("hlabel iscore dsum_jac routes", """SELECT driver, rid, label, round(best, 10) best, round(mean, 10) mean,
    array_to_string(nodes, '>') path FROM (
        SELECT h.driver, h.rid, h.label, sum_d / members mean_d, min(sum_d / members) OVER w best, avg(sum_d / members) OVER w mean
        FROM hlabel h JOIN dsum_jac d USING (rid) LEFT JOIN (SELECT driver, label FROM iscore
            QUALIFY row_number() OVER (PARTITION BY driver ORDER BY round(score, 9), label) = 1) c ON c.driver = h.driver
        WHERE h.label = coalesce(c.label, -1) WINDOW w AS (PARTITION BY h.driver)) JOIN (SELECT rid, nodes FROM routes) USING (rid)
    QUALIFY row_number() OVER (PARTITION BY driver ORDER BY round(mean_d, 9), rid) = 1""")


# --- consistent weighted sampling, largest distances, clashes, lists --------------------------------
_U = [f"((('0x' || substr(dig, {6 * i + 1}, 6))::BIGINT::DOUBLE + 0.5) / {1 << 24}.0)" for i in range(5)]
CTES |= {
    "draws": ("merch", f"""SELECT item, i, -ln({_U[0]} * {_U[1]}) r, -ln({_U[2]} * {_U[3]}) c, {_U[4]} beta
        FROM (SELECT item, i, md5('w#' || item || '#' || i) dig FROM (SELECT DISTINCT item FROM merch), range({catalog.MERCH_SIGNATURE}) p(i))"""),
    "wsig": ("draws merch", f"""SELECT rid, i, {_token("item || '#' || t")} v FROM (
        SELECT rid, i, item, t, ln(c) - r * (t - beta + 1) a
        FROM (SELECT *, floor(ln(qty::DOUBLE) / r + beta)::BIGINT t FROM merch JOIN draws USING (item)))
        QUALIFY row_number() OVER (PARTITION BY rid, i ORDER BY a, item) = 1"""),
    "walk": ("slots stds routes", STATEMENTS["nearest_center_by_sroute"][1]),
    "extremes": ("posu possum", """SELECT p.sroute, p.n, p.mean_dist, 1 - min(coalesce(dot, 0)) max_dist
        FROM (SELECT sroute, n, sum(sum_d) / (n * (n - 1)) mean_dist FROM possum GROUP BY sroute, n) p
        JOIN (SELECT a.sroute, a.rid x, b.rid y, sum(a.u * b.u) dot FROM posu a JOIN posu b ON a.sroute = b.sroute AND a.slot = b.slot AND a.rid < b.rid
              GROUP BY ALL) d USING (sroute) GROUP BY ALL"""),
    "spreads": ("possum posu poscent stds", STATEMENTS["standard_spread"][1]),
}
_group_distance("dsum_weighted", "driver", "jaccard")
CTES["dsum_weighted"] = ("routes sig2 wsig", CTES["dsum_weighted"][1].replace("FROM msig", "FROM wsig"))
STATEMENTS |= {
    "merch_weighted_signatures": ("wsig", "SELECT rid, string_agg(v::VARCHAR, ',' ORDER BY i) signature FROM wsig GROUP BY rid"),
    "driver_mean_distance_weighted": ("dsum_weighted", "SELECT driver, rid, round(sum_d / members, 10) mean_d FROM dsum_weighted"),
    "standard_pair_extremes": ("extremes", "SELECT sroute, n, round(mean_dist, 6) mean_dist, round(max_dist, 6) max_dist FROM extremes"),
    "standard_pair_report": ("extremes", """SELECT round(avg(round(max_dist, 6)), 5) mean_max,
        round(avg(round(mean_dist, 6)), 5) mean_mean FROM extremes"""),
    "standard_spread_report": ("spreads", """SELECT count(*) clusters, round(avg(clustroid_d), 3) mean_clustroid_d,
        round(stddev_pop(clustroid_d), 3) std_clustroid_d, round(avg(plan_d), 3) mean_plan_d, round(stddev_pop(plan_d), 3) std_plan_d,
        round(1 - avg(clustroid_d) / avg(plan_d), 3) improvement FROM spreads"""),
    "nearest_center_walk": ("walk", """SELECT std_no, label, stopped_at IS NULL OR std_no < stopped_at placed, stopped_at, stopped_at IS NULL valid
        FROM walk, (SELECT min(b.std_no) stopped_at FROM walk a JOIN walk b ON a.label = b.label AND a.std_no < b.std_no)"""),
    "driver_route_lists": ("routes", f"""SELECT driver, chunk, count(*)::INTEGER n, string_agg(rid::VARCHAR, ',' ORDER BY rid) rids FROM (
        SELECT driver, rid, (row_number() OVER (PARTITION BY driver ORDER BY rid) - 1) // {catalog.ID_CHUNK} chunk FROM routes) GROUP BY driver, chunk"""),
    "running_divergence_by_trips": ("tideal", """SELECT round(avg(best), 6) mean_best, round(avg(mean), 6) mean_mean,
        round(avg(rb / rm), 6) running_ratio, round(avg(coalesce(round(best, 9) / nullif(round(mean, 9), 0), 0)), 6) driver_ratio,
        round((1 - avg(rb / rm)) * 100, 6) change FROM (
        SELECT best, mean, sum(best) OVER w rb, sum(mean) OVER w rm FROM tideal WINDOW w AS (ORDER BY driver ROWS UNBOUNDED PRECEDING))"""),
}


CTES |= {
    "gbands": ("sig2 gforms", f"""SELECT rid, i // {SIZE // BANDS} band, string_agg(v::VARCHAR, ',' ORDER BY i) key
        FROM sig2 WHERE rid IN (SELECT form FROM gforms) GROUP BY rid, i // {SIZE // BANDS}"""),
    "glsh": ("gbands", f"""SELECT a.rid a, b.rid b, count(*) / {BANDS} share FROM gbands a JOIN gbands b
        ON a.band = b.band AND a.key = b.key AND a.rid < b.rid GROUP BY a.rid, b.rid HAVING count(*) / {BANDS} >= {LIMIT!r}"""),
    "dbsizes": ("gcore clabel gboth", STATEMENTS["dbscan_routes"][1]),
}
STATEMENTS |= {
    **{f"driver_pairs_{name}_part": ("allpairs", f"""SELECT {PAIR}, round(d, 10) d FROM (
        SELECT {PAIR}, {pick}(1 - {JAC}, 1 - {RUZ}) d FROM allpairs) WHERE d <= {catalog.METRIC_MAX[name]} + 1e-9""")
       for name, pick in (("worse", "greatest"), ("better", "least"))},
    "candidate_distances": ("glsh gpairs gforms", f"""SELECT a, b, share, round(0.5 * (1 - {JAC}) + 0.5 * (1 - {RUZ}), 10) d FROM (
        SELECT l.*, coalesce(inter, 0) inter, coalesce(smin, 0) smin, x.n na, y.n nb, x.w wa, y.w wb FROM glsh l
        JOIN gforms x ON x.form = l.a JOIN gforms y ON y.form = l.b LEFT JOIN gpairs g ON g.a = l.a AND g.b = l.b)"""),
    "dbscan_cluster_sizes": ("dbsizes", "SELECT label, count(*) size FROM dbsizes WHERE label >= 0 GROUP BY label"),
    "written_routes": ("routes legs", """SELECT rid, driver::VARCHAR driver, sroute, array_to_string(nodes, '>') path, units
        FROM routes JOIN (SELECT rid, sum(qty)::BIGINT units FROM legs GROUP BY rid) USING (rid)"""),
}


def _ordered(names: list[str], done: list[str]) -> list[str]:
    for name in names:
        if name not in done:
            _ordered(CTES[name][0].split(), done)
            done.append(name)
    return done


RECURSIVE = {
    "reach": "node, c", "creach": "node, c", "preach": "node, c", "hreach": "driver, t, x, y", "hstep": "driver, i, best, keep",
    "hwalk": "x, driver, born, name, keep, pborn, pname",
}


def _statement(needs: str, body: str) -> str:
    names = _ordered(needs.split(), [])
    parts = []
    for name in names:
        head = f"{name}({RECURSIVE[name]}) AS" if name in RECURSIVE else f"{name} AS MATERIALIZED"
        parts.append(f"{head} ({CTES[name][1]})")
    keyword = "WITH RECURSIVE" if RECURSIVE.keys() & set(names) else "WITH"
    return f"{keyword} {', '.join(parts)} {body}"


# Signature lengths and thresholds, spelled out: the number of most divisors near the (divided) vocabulary, then fixed tiers.
TUNING = """, divisors AS (SELECT m, count(*) c FROM range(1, 300) a(m), range(1, 300) b(x) WHERE m % x = 0 GROUP BY m),
    counts AS (SELECT n, s, k, CASE WHEN k = 2 THEN w2 ELSE w3 END words FROM (
        SELECT *, (CASE WHEN shortest < 2 OR w3 * n > 100000000 THEN 2 ELSE 3 END)::INTEGER k FROM (
        SELECT count(*) n, min(trips) shortest, (SELECT count(*) FROM stds) s,
        (SELECT count(DISTINCT shingle) FROM sh2) w2, (SELECT count(DISTINCT shingle) FROM sh3) w3 FROM routes))),
    base AS (SELECT words // CASE WHEN words < 125 THEN 1 WHEN words < 500 THEN 2 ELSE 4 END near FROM counts),
    divisible AS (SELECT arg_max(m, c * 1000 + m) m FROM divisors, base WHERE m BETWEEN near - 14 AND near + 15)
    SELECT n routes, k, (CASE WHEN words < 1000 THEN m + m % 2 WHEN words < 10000 THEN 300 WHEN words < 100000 THEN 420 ELSE 510 END)::INTEGER signature,
        (CASE WHEN n * n <= 100000000 THEN 0 WHEN n * n < 500000000 THEN 0.1 WHEN n * n < 1000000000 THEN 0.2
              WHEN n * n < 10000000000 THEN 0.4 ELSE 0.9 END)::DOUBLE threshold,
        greatest(2, n // s // 3)::INTEGER min_size, greatest(2, n // s)::INTEGER max_size FROM counts, divisible"""


def statements() -> dict[str, str]:
    out = {name: _statement(needs, body) for name, (needs, body) in STATEMENTS.items()}
    out["tuning"] = _statement("routes stds sh2 sh3", TUNING)
    return out
