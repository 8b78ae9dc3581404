"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the driver's tables registered as views. The
fixture derivations are repeated here as CTEs so that the oracle is independent
of the Spark code that it checks. Containment and distance joins are written
as brute force (every cell against every region/edge) on purpose: that is the
definition the Spark plans must reproduce.
"""

from __future__ import annotations

import math

GRID_FACTS = """
grid_facts as (
  select date_trunc('month', l_shipdate) as time, year(l_shipdate) as year,
         l_partkey % 37 as lat_idx, (l_orderkey*7 + l_linenumber) % 72 as lon_idx,
         cast(90 - 5*(l_partkey % 37) as double) as lat,
         cast(5*((l_orderkey*7 + l_linenumber) % 72) as double) as lon,
         case when l_orderkey % 11 = 0 then null else 250 + l_quantity end as t2m
  from lineitem)"""

REGIONS_BOX = """
regions_box as (
  select region_id, name, clon - half as lon0, clon + half as lon1,
         clat - half as lat0, clat + half as lat1, clon, clat
  from (select n_nationkey as region_id, n_name as name,
               cast(-170 + 13.6*n_nationkey as double) as clon,
               cast(-58.7 + 5*n_nationkey as double) as clat,
               cast(case when n_nationkey % 5 = 0 then 0.4 else 9.0 end as double) as half
        from nation) r)"""

# all grid nodes of the 5-degree grid, lon wrapped to -180..180
GRID_NODES = """
nodes as (
  select distinct lat, ((lon + 180) % 360) - 180 as lon, lat_idx, lon_idx from grid_facts)"""

CUST_BOX = """
cust_box as (
  select region_id, name, clon - half as lon0, clon + half as lon1, clat - half as lat0, clat + half as lat1,
         clon, clat
  from (select c_custkey as region_id, c_name as name,
               cast(c_custkey % 3597 as double) / 10.0 - 179.83 as clon,
               cast(c_custkey % 1193 as double) / 10.0 - 59.67 as clat,
               cast(3 + c_custkey % 5 as double) as half
        from customer) c)"""

# triangle edges (lon0,lat0) -> (lon1,lat0) -> (clon,lat1) -> (lon0,lat0) of the customer boxes
TRI_EDGES = """
tri_edges as (
  select region_id, lon0 as x0, lat0 as y0, lon1 as x1, lat0 as y1 from cust_box
  union all select region_id, lon1, lat0, clon, lat1 from cust_box
  union all select region_id, clon, lat1, lon0, lat0 from cust_box)"""

BOX_CELLS = """
cell as (
  select r.region_id, r.name, g.time, g.year, g.lat, cos(radians(g.lat)) as w, g.t2m - 273.15 as v
  from grid_facts g join regions_box r
    on g.lat >= r.lat0 and g.lat < r.lat1
   and ((g.lon + 180) % 360) - 180 >= r.lon0 and ((g.lon + 180) % 360) - 180 < r.lon1)"""


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["annual_means_box"] = _with(GRID_FACTS, REGIONS_BOX, BOX_CELLS) + """,
m as (select name, year, time, sum(w*v)/sum(case when v is not null then w end) as mt
      from cell group by name, year, time)
select name as country, cast(year as int) as year, round(avg(mt), 6) as temp_c
from m group by name, year"""

CO2_RAW = """
co2_raw as (
  select case when o_orderkey % 50 = 0 then 'OWID_WRL' when o_orderkey % 50 = 1 then 'eu'
              when o_orderkey % 50 = 2 then null
              else lower(concat('N', lpad(cast(c_nationkey as varchar), 2, '0'))) end as iso_code,
         year(o_orderdate) as year,
         sum(o_totalprice)/1e6 as co2, avg(o_totalprice)/1e5 as co2_per_capita,
         max(o_totalprice)/1e6 as share_global_co2, min(o_totalprice)/1e6 as consumption_co2
  from orders join customer on o_custkey = c_custkey group by 1, 2)"""

_YEARS = list(range(1995, 2002))
_SERIES = ["NY.GDP.PCAP.KD", "GE.EST", "RL.EST", "RQ.EST", "CC.EST", "PV.EST", "VA.EST"]
_SHORT = ["gdp_pc_const_usd", "wgi_gov_effectiveness", "wgi_rule_of_law", "wgi_reg_quality",
          "wgi_control_corruption", "wgi_political_stability", "wgi_voice_accountability"]

INDICATORS_WIDE = """
indicators_wide as (
  select concat('N', lpad(cast(s_nationkey as varchar), 2, '0')) as economy,
         case l_linenumber """ + " ".join(f"when {i + 1} then '{s}'" for i, s in enumerate(_SERIES[:-1])) + \
    f" else '{_SERIES[-1]}' end as series,\n         " + ",\n         ".join(
        f"avg(case when year(l_shipdate) = {y} then l_extendedprice end) as YR{y}" for y in _YEARS) + """
  from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2)"""

WB_LONG = """
wb_long as (
  """ + "\n  union all ".join(
    f"select economy as iso3, series, try_cast(regexp_replace('yr{y}', '^yr', '') as integer) as year, "
    f"cast(YR{y} as double) as value from indicators_wide where length(economy) = 3" for y in _YEARS) + ")"

CO2_CLEAN = """
co2_clean as (
  select upper(iso_code) as iso3, cast(year as int) as year, co2 as co2_mt, co2_per_capita as co2_t_per_capita,
         share_global_co2 as share_global_co2_pct, consumption_co2 as consumption_co2_mt
  from co2_raw where length(upper(iso_code)) = 3 and not starts_with(upper(iso_code), 'OWID') and year >= 1996)"""

WB_TIDY = """
wb_tidy as (
  select iso3, year, """ + ", ".join(
    f"max(value) filter (where series = '{s}') as {n}" for s, n in zip(_SERIES, _SHORT)) + """
  from wb_long where value is not null and year is not null and iso3 is not null group by iso3, year)"""

TEMP_PANEL = """
temp_m as (select region_id, name, year, time, sum(w*v)/sum(case when v is not null then w end) as mt
           from cell group by region_id, name, year, time),
temp_panel as (select concat('N', lpad(cast(region_id as varchar), 2, '0')) as iso3, cast(year as int) as year,
                      name as country, avg(mt) as temp_c from temp_m group by region_id, name, year)"""


def _r6(cols):
    return ", ".join(f"round({c}, 6) as {c}" for c in cols)


ORACLES["co2_clean"] = _with(CO2_RAW, CO2_CLEAN) + f"""
select iso3, year, {_r6(['co2_mt', 'co2_t_per_capita', 'share_global_co2_pct', 'consumption_co2_mt'])}
from co2_clean"""

ORACLES["wb_melt"] = _with(INDICATORS_WIDE, WB_LONG) + "select iso3, series, year, round(value, 6) as value from wb_long"

ORACLES["wb_tidy"] = _with(INDICATORS_WIDE, WB_LONG, WB_TIDY) + f"select iso3, year, {_r6(_SHORT)} from wb_tidy"

_ODD_TWICE = INDICATORS_WIDE
for _y in _YEARS:
    if _y % 2:
        _ODD_TWICE = _ODD_TWICE.replace(f"l_extendedprice end) as YR{_y}", f"l_extendedprice end) * 2 as YR{_y}")
ORACLES["wb_first_rows"] = ORACLES["wb_tidy"].replace(INDICATORS_WIDE, _ODD_TWICE)

ORACLES["keep_iso3_year"] = """
with r as (
  select case when o_orderkey % 50 = 0 then 'OWID_WRL' when o_orderkey % 50 = 1 then 'eu'
              when o_orderkey % 50 = 2 then null
              when o_orderkey % 2 = 0 then lower(concat('N', lpad(cast(c_nationkey as varchar), 2, '0')))
              else concat('N', lpad(cast(c_nationkey as varchar), 2, '0')) end as iso3,
         year(o_orderdate) as year, o_orderkey, o_totalprice
  from orders join customer on o_custkey = c_custkey),
c as (select upper(iso3) as iso3, cast(year as int) as year, o_orderkey, o_totalprice
      from r where iso3 is not null and length(upper(iso3)) = 3),
k as (select *, row_number() over (partition by iso3, year order by o_orderkey) as rn from c)
select iso3, year, o_orderkey, o_totalprice from k where rn = 1"""

_PANELS = _with(GRID_FACTS, REGIONS_BOX, BOX_CELLS, TEMP_PANEL, CO2_RAW, CO2_CLEAN, INDICATORS_WIDE,
                WB_LONG, WB_TIDY)

ORACLES["align_years"] = _PANELS + """,
cap as (select least((select max(year) from temp_panel), (select max(year) from co2_clean),
                     (select max(year) from wb_tidy)) as y)
select 'temperature' as panel, count(*) as n_rows, min(year) as min_year, max(year) as max_year
  from temp_panel where year <= (select y from cap)
union all
select 'co2', count(*), min(year), max(year) from co2_clean where year <= (select y from cap)
union all
select 'indicators', count(*), min(year), max(year) from wb_tidy where year <= (select y from cap)"""

ORACLES["enrich"] = _PANELS + f""",
cap as (select least((select max(year) from temp_panel), (select max(year) from co2_clean),
                     (select max(year) from wb_tidy)) as y)
select t.iso3, t.year, t.country, round(t.temp_c, 6) as temp_c,
       {_r6(['c.co2_mt', 'c.co2_t_per_capita', 'c.share_global_co2_pct', 'c.consumption_co2_mt']).replace('as c.', 'as ')},
       {_r6(['w.' + s for s in _SHORT]).replace('as w.', 'as ')}
from temp_panel t join co2_clean c on t.iso3 = c.iso3 and t.year = c.year
                  join wb_tidy w on t.iso3 = w.iso3 and t.year = w.year
where t.year <= (select y from cap)"""

NORM_SQL = "regexp_replace(strip_accents(trim({x})), '[^\\x00-\\x7F]', '', 'g')"

ORACLES["norm_text"] = f"select doc_id, {NORM_SQL.format(x='text')} as norm from documents"


def _q(s):
    return "null" if s is None else "'" + s.replace("'", "''") + "'"


def _names_lookup_sql() -> str:
    from ..operators.names import ISO_FIELDS, NAME_OVERRIDES, iso_rows
    from .catalog import NATION_NAMES

    names = ", ".join(f"({i}, {_q(n)})" for i, n in enumerate(NATION_NAMES))
    ov = ", ".join(f"({_q(a)}, {_q(v)}, {i})" for i, (a, v) in enumerate(NAME_OVERRIDES))
    iso = []
    for r in iso_rows():
        for rank, f in enumerate(ISO_FIELDS):
            if r.get(f):
                iso.append(f"({_q(r[f])}, {_q(r['alpha_3'])}, {rank * 1000 + int(r['country_pos'])})")
    norm = NORM_SQL
    return f"""
with names(nationkey, country) as (values {names}),
ov(alias, iso3, priority) as (values {ov}),
ovn as (select alias_norm, iso3 from (
          select {norm.format(x='alias')} as alias_norm, iso3,
                 row_number() over (partition by {norm.format(x='alias')} order by priority) as rn from ov) t
        where rn = 1),
iso(ident, iso3, priority) as (values {", ".join(iso)}),
keys as (select key, iso3 from (select lower(ident) as key, iso3,
                                       row_number() over (partition by lower(ident) order by priority) as rn
                                from iso) t where rn = 1),
cust as (select c.c_custkey, n.country from customer c join names n on c.c_nationkey = n.nationkey),
d as (select distinct country from cust),
m as (select d.country,
             case when o1.alias is not null then o1.iso3
                  when o2.alias_norm is not null then o2.iso3
                  else coalesce(k1.iso3, k2.iso3) end as iso3
      from d left join ov o1 on d.country = o1.alias
             left join ovn o2 on {norm.format(x='d.country')} = o2.alias_norm
             left join keys k1 on lower(d.country) = k1.key
             left join keys k2 on lower({norm.format(x='d.country')}) = k2.key)
"""


def _lazy_names():
    base = _names_lookup_sql()
    ORACLES["iso3_lookup"] = base + """
select cust.country, m.iso3, count(*) as n_customers from cust join m on cust.country = m.country
group by cust.country, m.iso3"""
    ORACLES["iso3_unmapped"] = base + """,
u as (select distinct country from m where iso3 is null)
select country, (select count(*) from u) as n_unmapped from u"""


def all_oracles() -> dict[str, str]:
    _lazy_names()
    return dict(ORACLES)


# -- climate: fallback, shapes, distances --------------------------------------------

def _hav(lat1, lon1, lat2, lon2):
    return (f"2*6371.0088*asin(sqrt(pow(sin((radians({lat2}) - radians({lat1}))/2), 2) + "
            f"cos(radians({lat1}))*cos(radians({lat2}))*pow(sin((radians({lon2}) - radians({lon1}))/2), 2)))")


AXES = """
lat_axis as (select distinct lat, lat_idx from grid_facts),
lon_axis as (select distinct ((lon + 180) % 360) - 180 as lon, lon_idx from grid_facts),
mesh as (select a.lat, a.lat_idx, o.lon, o.lon_idx from lat_axis a cross join lon_axis o)"""

FALLBACK_BODY = """
pts as (select region_id, name, (lon0 + lon1)/2 as plon, (lat0 + lat1)/2 as plat from regions_box),
dist as (select p.region_id, p.name, m.lat, m.lon, m.lat_idx, m.lon_idx,
                """ + _hav("p.plat", "p.plon", "m.lat", "m.lon") + """ as km
         from pts p cross join mesh m),
best as (select * from (select *, row_number() over (partition by region_id order by km, lat_idx, lon_idx) as rn
                        from dist) t where rn = 1),
covered as (select distinct region_id from cell),
missing as (select * from best where region_id not in (select region_id from covered)),
fb_m as (select f.name, g.year, g.time, avg(g.t2m - 273.15) as mt
         from missing f join grid_facts g on g.lat_idx = f.lat_idx and g.lon_idx = f.lon_idx
         where f.km <= 230.0 group by f.name, g.year, g.time),
fb as (select name as country, cast(year as int) as year, avg(mt) as temp_c from fb_m group by name, year),
direct_m as (select name, year, time, sum(w*v)/sum(case when v is not null then w end) as mt
             from cell group by name, year, time),
direct as (select name as country, cast(year as int) as year, avg(mt) as temp_c from direct_m group by name, year)"""

FALLBACK = AXES + "," + FALLBACK_BODY

ORACLES["annual_means_full"] = _with(GRID_FACTS, REGIONS_BOX, BOX_CELLS, FALLBACK) + """
select country, year, round(temp_c, 6) as temp_c from direct
union all
select country, year, round(temp_c, 6) from fb where country not in (select country from direct)"""

ORACLES["fallback_series"] = _with(GRID_FACTS, REGIONS_BOX, BOX_CELLS, FALLBACK) + """
select country, year, round(temp_c, 6) as temp_c from fb"""

ORACLES["fallback_audit"] = _with(GRID_FACTS, REGIONS_BOX, BOX_CELLS, FALLBACK) + """
select name as country,
       case when km <= 230.0 then 'fallback_used' else 'no_cell_within_230.0km' end as status,
       round(km, 6) as min_km,
       case when km <= 230.0 then lat end as near_lat,
       case when km <= 230.0 then lon end as near_lon
from missing"""

def _full_of(where: str) -> str:
    facts = GRID_FACTS.replace("from lineitem)", f"from lineitem where {where})")
    return _with(facts, REGIONS_BOX, BOX_CELLS, FALLBACK) + """
select country, year, round(temp_c, 6) as temp_c from direct
union all
select country, year, round(temp_c, 6) from fb where country not in (select country from direct)"""


ORACLES["fallback_by_year"] = f"""
select * from ({_full_of("year(l_shipdate) <> 1997")}) a union all
select * from ({_full_of("year(l_shipdate) = 1997 and l_partkey % 37 <= 18")}) b"""

ORACLES["nearest_cell"] = _with(GRID_FACTS, CUST_BOX, AXES) + """,
y as (select region_id, lon0, lon1, clon, lat0, lat1, (lat0 + lat1) / 2.0 as sy from cust_box),
x as (select region_id, sy, lon1 + (sy - lat0) / ((lat1 - lat0) / (clon - lon1)) as xa,
             clon + (sy - lat1) / ((lat0 - lat1) / (lon0 - clon)) as xb from y),
pts as (select region_id, (least(xa, xb) + greatest(xa, xb)) / 2.0 as plon, sy as plat from x),
dist as (select p.region_id, m.lat, m.lon, m.lat_idx, m.lon_idx,
                """ + _hav("p.plat", "p.plon", "m.lat", "m.lon") + """ as km
         from pts p cross join mesh m),
best as (select * from (select *, row_number() over (partition by region_id order by km, lat_idx, lon_idx) as rn
                        from dist) t where rn = 1)
select region_id, round(km, 6) as min_km, lat as near_lat, lon as near_lon, km <= 230.0 as within_cap
from best"""

ORACLES["unweighted_means"] = _with(GRID_FACTS, REGIONS_BOX, BOX_CELLS) + """,
m as (select name, year, time, avg(v) as mt from cell group by name, year, time)
select name as country, cast(year as int) as year, round(avg(mt), 6) as temp_c from m group by name, year"""

# even-odd rule with the half-open crossing test; a crossing at x <= lon counts
_TRI_INSIDE = """
inside as (
  select e.region_id, m.lat, m.lon
  from mesh m join tri_edges e
    on least(e.y0, e.y1) <= m.lat and m.lat < greatest(e.y0, e.y1) and e.y0 <> e.y1
   and e.x0 + (m.lat - e.y0) * (e.x1 - e.x0) / (e.y1 - e.y0) <= m.lon
  group by e.region_id, m.lat, m.lon having count(*) % 2 = 1)"""

ORACLES["cover_scanline"] = _with(GRID_FACTS, CUST_BOX, AXES, TRI_EDGES, _TRI_INSIDE) + \
    "select region_id, lat, lon from inside"

def _ease_sql():
    # public constants written out here: a wrong value in the library must not pass.
    # Extents of the grid: x of 180 degrees 17367530.445 m, y of the pole 7342230.136 m.
    WGS84_A, f = 6378137.0, 1 / 298.257223563
    _E2 = f * (2 - f)
    _E = math.sqrt(_E2)
    K0 = math.cos(math.radians(30)) / math.sqrt(1 - _E2 * math.sin(math.radians(30)) ** 2)
    pole = 1 - _E2
    pole = pole * (1 / (1 - _E2) - math.log((1 - _E) / (1 + _E)) / (2 * _E))
    assert abs(WGS84_A * K0 * math.pi - 17367530.445) < 1e-3
    assert abs(WGS84_A / (2 * K0) * pole - 7342230.136) < 2e-3
    x = f"({WGS84_A * K0!r} * radians({{lon}}))"
    s = "sin(radians({lat}))"
    q = (f"({1 - _E2!r} * ({s} / (1.0 - {_E2!r} * {s} * {s}) - "
         f"ln((1.0 - {_E!r} * {s}) / (1.0 + {_E!r} * {s})) / {2 * _E!r}))")
    y = f"({WGS84_A / (2 * K0)!r} * {q})"
    return x, y


def _geo_oracles():
    ex, ey = _ease_sql()
    ORACLES["project_metres"] = (
        "with p as (select c_custkey, cast(c_custkey % 3600 as double) / 10.0 - 180.0 as lon, "
        "cast(c_custkey % 1799 as double) / 10.0 - 89.9 as lat from customer)\n"
        f"select c_custkey, round({ex.format(lon='lon')}, 3) as x, round({ey.format(lat='lat')}, 3) as y from p")
    proj_edges = f"""
pe as (select region_id, {ex.format(lon='x0')} as ax, {ey.format(lat='y0')} as ay,
              {ex.format(lon='x1')} as b_x, {ey.format(lat='y1')} as b_y from tri_edges),
pm as (select lat, lon, {ex.format(lon='lon')} as px, {ey.format(lat='lat')} as py from mesh),
seg as (select pe.region_id, pm.lat, pm.lon, pm.px, pm.py, pe.ax, pe.ay, pe.b_x, pe.b_y,
               (pe.b_x - pe.ax) * (pe.b_x - pe.ax) + (pe.b_y - pe.ay) * (pe.b_y - pe.ay) as len2
        from pe cross join pm),
segt as (select *, greatest(0.0, least(1.0, case when len2 > 0 then
                 ((px - ax) * (b_x - ax) + (py - ay) * (b_y - ay)) / len2 else 0.0 end)) as t from seg),
near_edge as (select distinct region_id, lat, lon from segt
              where sqrt(pow(px - (ax + t * (b_x - ax)), 2) + pow(py - (ay + t * (b_y - ay)), 2)) <= 300000.0)"""
    ORACLES["cover_buffered"] = _with(GRID_FACTS, CUST_BOX, AXES, TRI_EDGES, _TRI_INSIDE, proj_edges) + """
select region_id, lat, lon from inside union select region_id, lat, lon from near_edge"""


_geo_oracles()

ORACLES["cover_overlap_counts"] = _with(GRID_FACTS, REGIONS_BOX) + """,
nodes as (select distinct lat, ((lon + 180) % 360) - 180 as lon from grid_facts),
pc as (select n.lat, n.lon, count(*) as n_regions from nodes n join regions_box r
         on n.lat >= r.lat0 and n.lat < r.lat1 and n.lon >= r.lon0 and n.lon < r.lon1
       group by n.lat, n.lon)
select n_regions, count(*) as n_cells from pc group by n_regions"""

ORACLES["centroid"] = _with(CUST_BOX, TRI_EDGES) + """,
s as (select region_id, sum(x0*y1 - x1*y0) as a2, sum((x0 + x1)*(x0*y1 - x1*y0)) as mx,
             sum((y0 + y1)*(x0*y1 - x1*y0)) as my from tri_edges group by region_id)
select region_id, round(mx / (3.0 * a2), 6) as cx, round(my / (3.0 * a2), 6) as cy from s"""

# scan line halfway between the base and the apex; crossings on the two slanted edges
ORACLES["representative_point"] = _with(CUST_BOX) + """,
y as (select region_id, lon0, lon1, clon, lat0, lat1, (lat0 + lat1) / 2.0 as sy from cust_box),
x as (select region_id, sy,
             lon1 + (sy - lat0) / ((lat1 - lat0) / (clon - lon1)) as xa,
             clon + (sy - lat1) / ((lat0 - lat1) / (lon0 - clon)) as xb from y)
select region_id, round((least(xa, xb) + greatest(xa, xb)) / 2.0, 6) as rx, round(sy, 6) as ry from x"""

ORACLES["haversine_pairs"] = _with(REGIONS_BOX) + """
select s.s_nationkey, c.c_nationkey, count(*) as n_lines,
       round(avg(""" + _hav("sb.clat", "sb.clon", "cb.clat", "cb.clon") + """), 6) as avg_km
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
     join customer c on o.o_custkey = c.c_custkey
     join supplier s on l.l_suppkey = s.s_suppkey
     join regions_box sb on sb.region_id = s.s_nationkey
     join regions_box cb on cb.region_id = c.c_nationkey
group by s.s_nationkey, c.c_nationkey"""

ORACLES["grid_mesh"] = _with(GRID_FACTS, AXES) + "select lat, lon from mesh"

ORACLES["array_flatten"] = """
with u as (select vec_id, unnest(generate_series(0, len(embedding) - 1)) as pos, embedding from embeddings
           where len(embedding) > 0)
select vec_id, cast(pos as int) as pos, cast(pos // 8 as int) as r, cast(pos % 8 as int) as c,
       embedding[pos + 1] as value
from u"""


# -- publish, quality, year sets ------------------------------------------------------

_FLAGSHIP = ORACLES["annual_means_box"]
_FULL = _with(GRID_FACTS, REGIONS_BOX, BOX_CELLS, FALLBACK) + """,
full_ as (select country, year, temp_c from direct
          union all select country, year, temp_c from fb where country not in (select country from direct))"""

ORACLES["parquet_roundtrip"] = _FLAGSHIP
ORACLES["path_year"] = f"select year as path_year, count(*) as n_rows from ({_FLAGSHIP}) f group by year"
ORACLES["publish_rows"] = f"select * from ({_FLAGSHIP}) f where year between 1996 and 2000"
ORACLES["publish_first_rows"] = (f"select country, year, round(temp_c + 1.0, 6) as temp_c from ({_FLAGSHIP}) f "
                                 "where year between 1996 and 2000")
ORACLES["partition_drift"] = f"""
with years as (select distinct year from ({_FLAGSHIP}) f)
select cast(year as int) as year, 'temp_c (string, not double)' as problem, cast(1 as bigint) as n_files from years where year % 3 = 0
union all select cast(year as int), unnest(['country (lacking)', 'note (not expected)']), 1 from years where year % 3 = 1"""
ORACLES["annual_means_runs"] = ORACLES["annual_means_full"]
ORACLES["tile_means"] = _with(GRID_FACTS, REGIONS_BOX) + """,
one as (select time, year, lat, ((lon + 180) % 360) - 180 as lon, avg(t2m - 273.15) as v from grid_facts group by all),
m as (select name, year, time, sum(cos(radians(lat))*v)/sum(cos(radians(lat))) as mt
      from one join regions_box r on lat >= lat0 and lat < lat1 and lon >= lon0 and lon < lon1
      where v is not null group by name, year, time)
select name as country, cast(year as int) as year, round(avg(mt), 6) as temp_c from m group by name, year"""
ORACLES["publish_stats"] = f"""
select count(distinct year) as n_partitions, count(distinct country) as n_countries, count(*) as n_rows,
       min(year) as y_min, max(year) as y_max
from ({_FLAGSHIP}) f where year between 1996 and 2000"""

ORACLES["geom_quality"] = _with(CUST_BOX) + """
select 'raw' as stage, count(*) as n_rows, count(*) filter (where region_id % 7 = 3) as n_null,
       count(*) filter (where region_id % 7 = 5) as n_empty, count(distinct name) as n_regions from cust_box
union all
select 'clean', count(*) filter (where region_id % 7 not in (3, 5)), 0, 0,
       count(distinct name) filter (where region_id % 7 not in (3, 5)) from cust_box"""

ORACLES["geom_sample_names"] = _with(CUST_BOX) + """
select region_id, name from cust_box where region_id % 7 not in (3, 5) order by region_id limit 5"""

ORACLES["temp_outliers"] = _with(GRID_FACTS, REGIONS_BOX, BOX_CELLS) + """,
m as (select name, year, time, sum(w*v)/sum(case when v is not null then w end) as mt
      from cell group by name, year, time)
select count(*) as n_rows, count(*) filter (where mt < -60.0 or mt > 60.0) as n_out_of_range,
       round(min(mt), 6) as min_temp_c, round(max(mt), 6) as max_temp_c from m"""

ORACLES["latest_stats"] = _FULL + """
select year, count(*) as n_rows, round(avg(temp_c), 6) as mean, round(min(temp_c), 6) as min,
       round(max(temp_c), 6) as max, round(stddev_samp(temp_c), 6) as std
from full_ where year = (select max(year) from full_) group by year"""

ORACLES["coverage_report"] = _FULL + """,
used as (select distinct name as country from missing where km <= 230.0),
present as (select distinct country from full_),
c as (select
  (select count(distinct name) from regions_box) as n_expected,
  (select count(*) from present where country not in (select country from used)) as n_direct,
  (select count(*) from used) as n_fallback,
  (select count(*) from (select distinct name from regions_box) e
     where name not in (select country from present)) as n_missing,
  (select count(*) from (select distinct name from regions_box) e cross join range(1996, 2004) y(y)
     where not exists (select 1 from full_ f where f.country = e.name and f.year = y.y)) as n_gaps,
  (select count(distinct year) from full_ where year not between 1996 and 2003) as n_outside,
  (select count(*) from range(1996, 2004) y(y) where y not in (select year from grid_facts)) as n_unlanded,
  (select count(*) from full_ where temp_c < -60.0 or temp_c > 60.0) as n_range)
select 'countries_expected' as "check", 'info' as severity, n_expected as n, true as passed from c
union all select 'direct_coverage', 'info', n_direct, true from c
union all select 'fallback_used', 'info', n_fallback, true from c
union all select 'missing_after_fallback', 'error', n_missing, n_missing = 0 from c
union all select 'country_years_missing', 'warn', n_gaps, n_gaps = 0 from c
union all select 'years_outside_request', 'warn', n_outside, n_outside = 0 from c
union all select 'temp_out_of_range', 'warn', n_range, n_range = 0 from c
union all select 'source_years_missing', 'warn', n_unlanded, n_unlanded = 0 from c
union all select 'regions_without_polygon', 'error', 0, true from c"""

ORACLES["top_regions"] = _FULL + """
select country, year, round(temp_c, 6) as temp_c from full_ where year = (select max(year) from full_)
order by temp_c desc nulls last, country limit 5"""

ORACLES["sample_latest"] = _FULL + """
select country, year, round(temp_c, 6) as temp_c from full_ where year = (select max(year) from full_)
order by md5(country), country limit 5"""

ORACLES["year_spec_filter"] = """
select cast(year(o_orderdate) as int) as year, count(*) as n_orders from orders
where year(o_orderdate) in (1996, 1998, 2000) group by 1"""

ORACLES["years_to_load"] = """
select cast(y as int) as year from generate_series(1990, 2005) t(y)
where y not in (select distinct year(o_orderdate) from orders)"""

ORACLES["years_outside"] = f"""
select distinct year from ({_FLAGSHIP}) f where year not in (1996, 1997, 1998, 1999)"""


def _buffered_annual():
    ex, ey = _ease_sql()
    box_edges = """
box_edges as (
  select region_id, lon0 as x0, lat0 as y0, lon1 as x1, lat0 as y1 from regions_box
  union all select region_id, lon1, lat0, lon1, lat1 from regions_box
  union all select region_id, lon1, lat1, lon0, lat1 from regions_box
  union all select region_id, lon0, lat1, lon0, lat0 from regions_box)"""
    near = f"""
pe as (select region_id, {ex.format(lon='x0')} as ax, {ey.format(lat='y0')} as ay,
              {ex.format(lon='x1')} as b_x, {ey.format(lat='y1')} as b_y from box_edges),
pm as (select lat, lon, {ex.format(lon='lon')} as px, {ey.format(lat='lat')} as py from mesh),
seg as (select pe.region_id, pm.lat, pm.lon, pm.px, pm.py, pe.ax, pe.ay, pe.b_x, pe.b_y,
               (pe.b_x - pe.ax) * (pe.b_x - pe.ax) + (pe.b_y - pe.ay) * (pe.b_y - pe.ay) as len2
        from pe cross join pm),
segt as (select *, greatest(0.0, least(1.0, case when len2 > 0 then
                 ((px - ax) * (b_x - ax) + (py - ay) * (b_y - ay)) / len2 else 0.0 end)) as t from seg),
bcells as (
  select distinct region_id, lat, lon from segt
   where sqrt(pow(px - (ax + t * (b_x - ax)), 2) + pow(py - (ay + t * (b_y - ay)), 2)) <= 200000.0
  union
  select r.region_id, m.lat, m.lon from mesh m join regions_box r
    on m.lat >= r.lat0 and m.lat < r.lat1 and m.lon >= r.lon0 and m.lon < r.lon1),
cell as (
  select r.region_id, r.name, g.time, g.year, g.lat, cos(radians(g.lat)) as w, g.t2m - 273.15 as v
  from grid_facts g join bcells b on g.lat = b.lat and ((g.lon + 180) % 360) - 180 = b.lon
  join regions_box r on r.region_id = b.region_id)"""
    return _with(GRID_FACTS, REGIONS_BOX, AXES, box_edges, near, FALLBACK_BODY) + """
select country, year, round(temp_c, 6) as temp_c from direct
union all
select country, year, round(temp_c, 6) from fb where country not in (select country from direct)"""


ORACLES["annual_means_buffered"] = _buffered_annual()


# -- readers and sinks on landed files ---------------------------------------------------

ORACLES["co2_csv_scan"] = _with(CO2_RAW, CO2_CLEAN) + f"""
select iso3, year, round(case when year in (1996, 1997) then null else co2_mt end, 6) as co2_mt,
       {_r6(['co2_t_per_capita', 'share_global_co2_pct', 'consumption_co2_mt'])}
from co2_clean"""

ORACLES["wb_dirty_tidy"] = ORACLES["wb_tidy"]

ORACLES["geojson_regions"] = _with(REGIONS_BOX) + """
select cast(row_number() over (order by region_id % 2, region_id) - 1 as int) as region_id, name,
       cast(5 as bigint) as n_points, lon0, lat1 from regions_box"""

ORACLES["dissolved_means"] = _with(GRID_FACTS, REGIONS_BOX) + """,
rc as (
  select r.r_name, g.time, g.year, cos(radians(g.lat)) as w, g.t2m - 273.15 as v
  from grid_facts g cross join region r
  where exists (select 1 from regions_box b join nation n on n.n_nationkey = b.region_id
                where n.n_regionkey = r.r_regionkey and g.lat >= b.lat0 and g.lat < b.lat1
                  and ((g.lon + 180) % 360) - 180 >= b.lon0 and ((g.lon + 180) % 360) - 180 < b.lon1)),
m as (select r_name, year, time, sum(w*v)/sum(case when v is not null then w end) as mt
      from rc group by r_name, year, time)
select r_name as country, cast(year as int) as year, round(avg(mt), 6) as temp_c from m group by r_name, year"""

ORACLES["grid_years_scan"] = _with(GRID_FACTS) + """
select cast(year as int) as year, count(*) as n_rows, count(t2m) as n_values
from grid_facts where year in (1996, 1998) group by year"""

ORACLES["publish_csv_lines"] = f"""
select cast(row_number() over (order by country, year) as int) as line_no, country, year, temp_c
from ({_FLAGSHIP}) f where year between 1996 and 2000"""

ORACLES["regions_in_band"] = _with(CUST_BOX) + """
select region_id, name, cast(4 as bigint) as n_points from cust_box where lat1 >= 0 and lat0 <= 30"""

ORACLES["years_to_reload"] = _with(GRID_FACTS) + """
select cast(y as int) as year from generate_series(1994, 2002) t(y)
where y not in (select year from grid_facts group by year having count(distinct month(time)) = 12)"""
