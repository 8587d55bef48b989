"""DuckDB oracle SQL for every registered query (see __spark_entry__.py).

Each string is independent ANSI-ish SQL over the pre-registered views. The
fixture definitions (positions, ways, trips, route lines derived from
``events``) are shared text; everything downstream is written from the
operator semantics, not from the Spark code.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixtures
EV = "select user_id, event_id, cast(floor(epoch_us(ts)/1000000.0) as bigint) as epoch_s from events"

POS = f"""
pos as (
 select user_id, event_id, copy,
  cast(1711404000 + (user_id % 10)*86400 + k as bigint) as vehicle_ts,
  cast(1711404000 + (user_id % 10)*86400 + k + copy*30 + case when event_id % 50 = 0 then 500 else 10 end as bigint) as feed_ts,
  concat('V', cast(user_id as varchar)) as vehicle_id,
  case when event_id % 41 = 0 then null else concat('T', cast(user_id as varchar), '_', cast(cast(floor(k/1500.0) as int) as varchar)) end as trip_id,
  concat('R', cast(user_id % 8 as varchar)) as route_id,
  case when event_id % 97 = 0 then 45.0e0 else 41.89e0 + (user_id % 8)*0.001e0 + ((event_id % 7) - 3)*0.00004e0 end as lat,
  12.45e0 + 0.00005e0*k + (((event_id*37) % 11) - 5)*0.0002e0 as lon,
  lpad(cast(event_id as varchar), 12, '0') as entity_id,
  concat('fixture/', cast(cast(1711404000 + (user_id % 10)*86400 + k + copy*30 + case when event_id % 50 = 0 then 500 else 10 end as bigint) as varchar), '.json') as source_file
 from (select user_id, event_id, unnest(generate_series(0, event_id % 3)) as copy,
              cast(floor((epoch_s - 1704067200)/600.0) as bigint) as k from ({EV}) e) q
)"""

CLEAN = """
clean as (
 select * from pos
 where vehicle_ts is not null and vehicle_id is not null
   and lat between 41.68e0 and 42.10e0 and lon between 12.20e0 and 12.75e0
   and feed_ts - vehicle_ts <= 120
)"""

DEDUP = """
dedup as (
 select * from clean
 qualify row_number() over (partition by vehicle_id, vehicle_ts order by feed_ts, entity_id, source_file) = 1
)"""


def haversine(lat1, lon1, lat2, lon2):
    def hav(d):
        half = f"sin(radians({d}) / 2)"
        return f"({half} * {half})"

    return (f"(asin(sqrt({hav(f'({lat2} - {lat1})')} + "
            f"(cos(radians({lat1})) * cos(radians({lat2}))) * {hav(f'({lon2} - {lon1})')})) * 12742000.0e0)")


SEG = f"""
paired as (
 select *, lag(lat) over w as plat, lag(lon) over w as plon, lag(vehicle_ts) over w as pts, lag(trip_id) over w as ptrip
 from dedup window w as (partition by vehicle_id order by vehicle_ts)
),
seg0 as (
 select vehicle_id, trip_id, route_id, pts as from_epoch, vehicle_ts as to_epoch, vehicle_ts - pts as duration_s,
   plat as from_lat, plon as from_lon, lat as to_lat, lon as to_lon, {haversine('plat', 'plon', 'lat', 'lon')} as distance_m
 from paired where pts is not null and trip_id = ptrip and vehicle_ts - pts between 5 and 90
),
seg as (
 select *, distance_m / duration_s * 3.6e0 as speed_kmh,
   cast(timezone('Europe/Rome', to_timestamp(to_epoch)) as date) as date_rome,
   cast(hour(timezone('Europe/Rome', to_timestamp(to_epoch))) as integer) as hour_rome
 from seg0 where distance_m / duration_s * 3.6e0 <= 100
)"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes)


SEG_COLS = ("vehicle_id, trip_id, route_id, from_epoch, to_epoch, duration_s, distance_m, speed_kmh, "
            "from_lat, from_lon, to_lat, to_lon")

Q: dict[str, str] = {}

Q["positions_clean"] = with_(POS, CLEAN) + """
select entity_id, vehicle_id, trip_id, route_id, feed_ts as feed_epoch, vehicle_ts as vehicle_epoch,
  lat as latitude, lon as longitude, cast(to_timestamp(feed_ts) as date) as date
from clean"""

Q["positions_dedup"] = with_(POS, CLEAN, DEDUP) + """
select entity_id, vehicle_id, trip_id, feed_ts as feed_epoch, vehicle_ts as vehicle_epoch, lat as latitude, lon as longitude
from dedup"""

Q["segments"] = with_(POS, CLEAN, DEDUP, SEG) + f"select {SEG_COLS} from seg"

Q["stream_segments"] = Q["segments"]

Q["segments_local_time"] = with_(POS, CLEAN, DEDUP, SEG) + """
select vehicle_id, to_epoch, date_rome, hour_rome, cast(isodow(date_rome) - 1 as integer) as dow
from seg where date_rome between date '2024-03-26' and date '2024-04-03'"""

Q["route_hour_speed"] = with_(POS, CLEAN, DEDUP, SEG) + """
select route_id, cast(isodow(date_rome) - 1 as integer) as dow, hour_rome,
  count(*) as segments, round(quantile_disc(speed_kmh, 0.5), 1) as median_speed_kmh
from seg group by all"""

# ------------------------------------------------------------------- ways
# vertex rows of every way: (way_id, vseq, lat, lon, name, highway, bus_ok, present)
VERT = f"""
grid_v as (
 select 1000*kind + 10*r + j as way_id, s as vseq,
   41.89e0 + r*0.001e0 + (kind-1)*0.0001e0 as lat, 12.445e0 + j*0.04e0 + s*0.005e0 as lon
 from (select kind, r, j, unnest(generate_series(0, 8)) as s from
   (select kind, r, unnest(generate_series(0, 5)) as j from
     (select kind, unnest(generate_series(0, 7)) as r from (select unnest(generate_series(1, 2)) as kind) a) b) c) d
 union all
 select 3000 + j, 0, 41.8895e0 + j*0.0e0, 12.4475e0 + j*0.02e0 from (select unnest(generate_series(0, 10)) as j) x
 union all
 select 3000 + j, 1, 41.8975e0 + j*0.0e0, 12.4475e0 + j*0.02e0 from (select unnest(generate_series(0, 10)) as j) x
),
grid_w as (
 select distinct way_id, concat('Street ', cast(way_id as varchar)) as name,
   case when way_id < 2000 then 'primary' when way_id < 3000 then 'residential' else 'tertiary' end as highway
 from grid_v
),
blk as (select event_id // 8 as b, cast(event_id % 8 as integer) as pos from events),
blk_v as (
 select b + 100000 as way_id, pos as vseq,
   case when b % 19 = 0 then 45.0e0 else 41.95e0 + (b % 120)*0.001e0 + pos*0.00001e0 end as lat,
   12.25e0 + ((b // 120) % 40)*0.01e0 + pos*0.0002e0 as lon
 from blk where not (b % 13 = 0 and pos > 0) and b % 17 <> 0
),
blk_w as (
 select distinct b + 100000 as way_id,
   case when b % 9 = 0 then null else concat('Via ', cast(b as varchar)) end as name,
   ['primary','residential','service','service','footway','living_street','busway'][b % 7 + 1] as highway,
   b % 7 = 2 as bus_ok
 from blk
),
corner_v as (
 select event_id + 500000000 as way_id, s as vseq,
   case when s = 0 then 42.0985e0 else 42.1005e0 end + case when event_id % 2 = 0 then 0.0e0 else 0.002e0 end as lat,
   case when s = 0 then 12.7505e0 else 12.7485e0 end as lon
 from (select event_id, unnest(generate_series(0, 1)) as s from events where event_id % 150 < 2) c
),
way_v as (select * from grid_v union all select * from blk_v union all select * from corner_v),
way_t as (select way_id, name, highway, false as bus_ok from grid_w union all select * from blk_w
          union all select distinct way_id, cast(null as varchar), 'trunk', false from corner_v),
-- pieces of ways, and where along them the box begins and ends
piece as (
 select way_id, vseq, lat, lon, lead(lat) over w - lat as dlat, lead(lon) over w - lon as dlon
 from way_v window w as (partition by way_id order by vseq)
),
cut as (
 select way_id, greatest(0.0e0,
     case when dlat = 0 then 0.0e0 else least((41.68e0 - lat) / dlat, (42.10e0 - lat) / dlat) end,
     case when dlon = 0 then 0.0e0 else least((12.20e0 - lon) / dlon, (12.75e0 - lon) / dlon) end) as t_in,
   least(1.0e0,
     case when dlat = 0 then 1.0e0 else greatest((41.68e0 - lat) / dlat, (42.10e0 - lat) / dlat) end,
     case when dlon = 0 then 1.0e0 else greatest((12.20e0 - lon) / dlon, (12.75e0 - lon) / dlon) end) as t_out
 from piece where dlat is not null
   and (dlat <> 0 or lat between 41.68e0 and 42.10e0) and (dlon <> 0 or lon between 12.20e0 and 12.75e0)
),
crossing as (select distinct way_id from cut where t_in <= t_out),
sel as (
 select t.way_id, t.name as street, t.highway, count(*) as vertices
 from way_t t join way_v v using (way_id)
 where t.highway in ('motorway','trunk','primary','secondary','tertiary','unclassified','residential','living_street',
                     'motorway_link','trunk_link','primary_link','secondary_link','tertiary_link','busway')
    or (t.highway = 'service' and t.bus_ok)
 group by all
 having bool_or(v.lat between 41.68e0 and 42.10e0 and v.lon between 12.20e0 and 12.75e0)
   or t.way_id in (select way_id from crossing)
),
edge0 as (
 select v.way_id, s.street, s.highway,
   cast(row_number() over w - 1 as bigint) as seq, v.lat as from_lat, v.lon as from_lon,
   lead(v.lat) over w as to_lat, lead(v.lon) over w as to_lon
 from way_v v join sel s using (way_id) window w as (partition by v.way_id order by v.vseq)
),
edges as (
 select way_id, street, highway, seq, from_lat, from_lon, to_lat, to_lon,
   {haversine('from_lat', 'from_lon', 'to_lat', 'to_lon')} as length_m
 from edge0 where to_lat is not null
),
street_len as (select way_id, sum(length_m) as street_m from edges group by way_id)"""

CELL = "cast(floor(({x}) / 0.00025e0) as integer)"


def cell(x):
    return CELL.format(x=x)


ECELLS = f"""
ecells as (
 select distinct way_id, seq, {cell('from_lat + (cast(st as double) / steps) * (to_lat - from_lat)')} as cell_lat,
   {cell('from_lon + (cast(st as double) / steps) * (to_lon - from_lon)')} as cell_lon
 from (select *, unnest(generate_series(0, steps)) as st from
   (select *, greatest(cast(ceil(length_m / 10.0e0) as integer), 1) as steps from edges) a) b
)"""


def snap(lat, lon):
    px, py = f"(({lon} - e.from_lon) * 82800.0e0)", f"(({lat} - e.from_lat) * 111320.0e0)"
    ex, ey = "((e.to_lon - e.from_lon) * 82800.0e0)", "((e.to_lat - e.from_lat) * 111320.0e0)"
    along, whole = f"({px} * {ex} + {py} * {ey})", f"({ex} * {ex} + {ey} * {ey})"
    return (f"(case when {along} <= 0 then sqrt({px} * {px} + {py} * {py}) "
            f"when {along} >= {whole} then sqrt(({px} - {ex}) * ({px} - {ex}) + ({py} - {ey}) * ({py} - {ey})) "
            f"else abs({px} * {ey} - {py} * {ex}) / sqrt({whole}) end)")


# --------------------------------------------------------------- schedule
RELS = """(select date '2024-03-27' as static_date, 0 as n union all select date '2024-03-28', 1
  union all select date '2024-03-30', 2 union all select date '2024-04-02', 3 union all select date '2024-04-05', 4)"""

SCHED = f"""
trips as (
 select v.static_date, concat('T', cast(u.user_id as varchar), '_', cast(u.i as varchar)) as trip_id,
   case when (u.user_id + 2 * u.i) % 13 = 0 then ''
     else concat('S', cast(u.user_id % 8 as varchar), '_', cast(u.user_id // 64 as varchar)) end as shape_id
 from (select user_id, unnest(generate_series(0, 2)) as i from (select distinct user_id from events) z) u
 cross join {RELS} v
 where (u.user_id + u.i + v.n) % 6 <> 0
),
shapes as (
 select v.static_date, concat('S', cast(r as varchar), '_', cast(b as varchar), spare) as shape_id,
   cast(seq as integer) as seq,
   41.89002e0 + r*0.001e0 + case when r = 2 and v.n >= 3 then 0.00001e0 else 0e0 end + b*0.000001e0 as lat,
   12.44e0 + seq*0.01e0 as lon
 from (select r, b, seq, unnest(['', 'x']) as spare from
   (select r, b, unnest(generate_series(0, 24)) as seq from
     (select distinct user_id % 8 as r, user_id // 64 as b from events) l) a) s
 cross join {RELS} v
),
used as (
 select * from shapes p
 where exists (select 1 from trips t where t.static_date = p.static_date and t.shape_id = p.shape_id and t.shape_id <> '')
),
geom as (select static_date, shape_id, list((seq, lat, lon) order by seq) as g from used group by all),
geom_rep as (
 select g, static_date as rep_date, shape_id as rep_shape from geom
 qualify row_number() over (partition by g order by static_date, shape_id) = 1
),
line_rep as (select l.static_date, l.shape_id, r.rep_date, r.rep_shape from geom l join geom_rep r using (g)),
trip_shape as (
 select t.static_date, t.trip_id, t.shape_id, l.rep_date, l.rep_shape
 from trips t join line_rep l using (static_date, shape_id) where t.shape_id <> ''
),
rep_pts as (
 select r.rep_date, r.rep_shape, p.seq, p.lat, p.lon
 from geom_rep r join shapes p on p.static_date = r.rep_date and p.shape_id = r.rep_shape
),
nxt as (
 select *, lead(lat) over w as next_lat, lead(lon) over w as next_lon
 from rep_pts window w as (partition by rep_date, rep_shape order by seq)
),
gaps as (
 select *, sqrt(((next_lon - lon) * 82800.0e0) * ((next_lon - lon) * 82800.0e0)
              + ((next_lat - lat) * 111320.0e0) * ((next_lat - lat) * 111320.0e0)) as gap_m
 from nxt where next_lat is not null
),
samples as (
 select rep_date, rep_shape, seq, cast(step as integer) as step, lat + (cast(step as double) / steps) * (next_lat - lat) as lat,
   lon + (cast(step as double) / steps) * (next_lon - lon) as lon, gap_m / steps as piece_m
 from (select *, unnest(generate_series(0, steps - 1)) as step from
   (select *, greatest(cast(ceil(gap_m / 5.0e0) as integer), 1) as steps from gaps) a) b
)
"""

LINES = f"""
ecand as (
 select distinct e.way_id, e.seq as edge_seq, e.street, e.highway, e.from_lat, e.from_lon, e.to_lat, e.to_lon, c.cell_lat, c.cell_lon
 from ecells c join edges e using (way_id, seq)
),
sample_cells as (
 select s.*, {cell('s.lat')} + dlat as cl, {cell('s.lon')} + dlon as cn
 from samples s, (select unnest([-1, 0, 1]) as dlat) a, (select unnest([-1, 0, 1]) as dlon) b
),
sample_cand as (
 select distinct s.rep_date, s.rep_shape, s.seq, s.step, s.piece_m, e.way_id, e.edge_seq, {snap('s.lat', 's.lon')} as snap_m
 from sample_cells s join ecand e on e.cell_lat = s.cl and e.cell_lon = s.cn
),
sample_near as (
 select * from sample_cand where snap_m <= 25
 qualify row_number() over (partition by rep_date, rep_shape, seq, step order by snap_m, way_id) = 1
),
shape_streets as (
 select m.rep_date, m.rep_shape, m.way_id, count(*) as points, round(avg(snap_m), 1) as snap_m,
   round(sum(piece_m), 1) as span_m, any_value(l.street_m) as street_m
 from sample_near m join street_len l using (way_id)
 group by m.rep_date, m.rep_shape, m.way_id
 having round(sum(piece_m), 1) >= least(30.0e0, any_value(l.street_m))
)"""

Q["ways_selected"] = with_(VERT) + " select way_id, street, highway, cast(vertices as integer) as vertices from sel"
Q["ways_with_vertex"] = with_(VERT) + """ select way_id, street, highway, cast(vertices as integer) as vertices from sel
where way_id in (select way_id from way_v where lat between 41.68e0 and 42.10e0 and lon between 12.20e0 and 12.75e0)"""
Q["ways_from_extract"] = Q["ways_selected"]
Q["street_edges"] = with_(VERT) + """
select way_id, street, highway, seq, from_lat, from_lon, to_lat, to_lon, round(length_m, 6) as length_m from edges"""
Q["street_length"] = with_(VERT) + " select way_id, round(street_m, 6) as street_m from street_len"
Q["edge_cells"] = with_(VERT, ECELLS) + " select way_id, seq, cell_lat, cell_lon from ecells"

Q["trips_with_shape"] = with_(SCHED) + " select * from trips where shape_id is not null and shape_id <> ''"
Q["shape_groups"] = with_(SCHED) + """
select s.static_date, s.shape_id, r.rep_date, r.rep_shape
from (select static_date, shape_id, list((seq, lat, lon) order by seq) as g from shapes group by all) s
join (select g, static_date as rep_date, shape_id as rep_shape from
        (select static_date, shape_id, list((seq, lat, lon) order by seq) as g from shapes group by all)
      qualify row_number() over (partition by g order by static_date, shape_id) = 1) r using (g)"""
Q["representative_shape"] = with_(SCHED) + " select rep_date as static_date, rep_shape as shape_id from geom_rep"
Q["used_shapes"] = with_(SCHED) + " select * from used"
Q["unmatched_lines"] = with_(SCHED) + """
select static_date, shape_id from (
 select static_date, shape_id, g from geom where static_date > date '2024-03-30'
 qualify row_number() over (partition by g order by static_date, shape_id) = 1) n
where g not in (select g from geom where static_date <= date '2024-03-30')"""
Q["line_resample"] = with_(SCHED) + " select rep_date, rep_shape, seq, step, lat, lon, piece_m from samples"
Q["neighbour_cells"] = with_(SCHED) + f"""
select rep_date, rep_shape, seq, step, {cell('lat')} + dlat as cell_lat, {cell('lon')} + dlon as cell_lon
from samples, (select unnest([-1, 0, 1]) as dlat) a, (select unnest([-1, 0, 1]) as dlon) b"""

Q["line_nearest_way"] = with_(VERT, ECELLS, SCHED, LINES) + " select rep_date, rep_shape, seq, step, way_id, snap_m from sample_near"
Q["shape_streets"] = with_(VERT, ECELLS, SCHED, LINES) + """
select rep_date, rep_shape, way_id, points, snap_m, round(street_m, 6) as street_m, span_m from shape_streets"""
Q["trip_shape"] = with_(SCHED) + " select * from trip_shape"

# ------------------------------------------------ releases, version lookup
REL_FILES = """
rel_files as (select static_date, cast(count(*) * 64 + 6400 as bigint) as length from trips group by static_date),
acc as (
 select static_date, length,
   coalesce(static_date in (select cast(x as date) from (values ('2024-03-27')) v(x)) and {loaded}, false)
   or lag(length) over (order by static_date) is null or lag(length) over (order by static_date) = 0
   or length >= 0.8e0 * lag(length) over (order by static_date) as accepted
 from rel_files
)"""

Q["release_acceptance"] = with_(SCHED, REL_FILES.format(loaded="false")) + " select * from acc"
Q["release_truncated"] = with_(SCHED, REL_FILES.format(loaded="false").replace("rel_files as (", "rel_0 as (", 1).replace(
    "acc as (", """more as (
 select * from rel_0 union all
 select date '2024-04-07' + cast(i as integer), cast(floor(length * share) as bigint)
 from (select arg_max(length, static_date) as length from rel_0) l,
   (values (0, 0.5e0), (1, 0.55e0), (2, 1.0e0)) v(i, share)
),
acc as (""", 1).replace("from rel_files", "from more")) + " select * from acc"
Q["version_cutoff"] = with_(SCHED, REL_FILES.format(loaded="false")) + """
select coalesce(max(static_date) filter (where static_date <= date '2024-06-27' - interval 90 day), min(static_date)) :: date as cutoff
from acc where accepted"""
Q["new_releases"] = with_(SCHED, REL_FILES.format(loaded="true")) + """
select static_date from acc
where accepted and static_date >= (select coalesce(max(static_date) filter (where static_date <= date '2024-06-27' - interval 90 day),
                                               min(static_date)) from acc where accepted)
  and static_date not in (date '2024-03-27')"""

VERSIONS = """
days as (select distinct date_rome from seg),
rels as (select distinct static_date from trip_shape),
day_rel as (
 select d.date_rome,
   coalesce((select max(static_date) from rels r where r.static_date <= d.date_rome), (select min(static_date) from rels)) as in_force,
   (select min(static_date) from rels r where r.static_date > d.date_rome) as next_rel
 from days d
),
day_versions as (
 select date_rome, in_force as static_date, 1 as priority from day_rel where in_force is not null
 union all select date_rome, next_rel, 2 from day_rel where next_rel is not null
),
trip_lookup as (
 select * from (select v.date_rome, t.trip_id, t.rep_date, t.rep_shape, v.priority
                from day_versions v join trip_shape t using (static_date))
 qualify row_number() over (partition by date_rome, trip_id order by priority) = 1
),
route_edges as (
 select distinct s.rep_date, s.rep_shape, e.way_id, e.seq as edge_seq, e.street, e.highway,
   e.from_lat, e.from_lon, e.to_lat, e.to_lon, c.cell_lat, c.cell_lon
 from shape_streets s join edges e using (way_id) join ecells c on c.way_id = e.way_id and c.seq = e.seq
 where (s.rep_date, s.rep_shape) in (select (rep_date, rep_shape) from trip_lookup)
),
seg_pts as (
 select s.*, l.rep_date, l.rep_shape, cast(isodow(s.date_rome) - 1 as integer) as dow,
   (s.from_lat + s.to_lat) / 2 as mid_lat, (s.from_lon + s.to_lon) / 2 as mid_lon
 from seg s join trip_lookup l using (date_rome, trip_id)
),
seg_cells as (
 select p.*, {c_lat} + dlat as cl, {c_lon} + dlon as cn
 from seg_pts p, (select unnest([-1, 0, 1]) as dlat) a, (select unnest([-1, 0, 1]) as dlon) b
),
seg_cand as (
 select distinct p.date_rome, p.dow, p.hour_rome, p.vehicle_id, p.route_id, p.to_epoch, p.speed_kmh,
   e.way_id, e.edge_seq, e.street, e.highway, {snap_m} as snap_m
 from seg_cells p join route_edges e
   on e.rep_date = p.rep_date and e.rep_shape = p.rep_shape and e.cell_lat = p.cl and e.cell_lon = p.cn
),
seg_streets as (
 select * from seg_cand where snap_m <= 25
 qualify row_number() over (partition by vehicle_id, to_epoch order by snap_m, way_id) = 1
)""".format(c_lat=cell("p.mid_lat"), c_lon=cell("p.mid_lon"), snap_m=snap("p.mid_lat", "p.mid_lon"))

ALL = (POS, CLEAN, DEDUP, SEG, VERT, ECELLS, SCHED, LINES, VERSIONS)

Q["release_in_force"] = with_(*ALL) + " select date_rome, static_date from day_versions where priority = 1"
Q["next_release"] = with_(*ALL) + " select date_rome, static_date from day_versions where priority = 2"
Q["trip_lookup"] = with_(*ALL) + " select date_rome, trip_id, cast(priority as integer) as priority, rep_date, rep_shape from trip_lookup"
Q["route_edges"] = with_(*ALL) + " select distinct rep_date, rep_shape, way_id, edge_seq as seq from route_edges"
Q["segment_nearest_way"] = with_(*ALL) + """
select date_rome, dow, hour_rome, vehicle_id, route_id, way_id, street, highway, speed_kmh, snap_m from seg_streets"""

SPEED = """
street_speed as (
 select way_id, street, highway, dow, hour_rome, count(*) as segments,
   count(distinct vehicle_id) as vehicles, count(distinct route_id) as routes, count(distinct date_rome) as days,
   round(avg(speed_kmh), 1) as avg_speed_kmh, round(quantile_disc(speed_kmh, 0.5), 1) as median_speed_kmh,
   cast((200 * count(*) filter (where speed_kmh > 1) + count(*)) // (2 * count(*)) as double) / 100.0e0 as moving_share,
   round(avg(snap_m), 1) as snap_m
 from seg_streets group by way_id, street, highway, dow, hour_rome
 having count(*) >= 20
)"""
Q["street_speed"] = with_(*ALL, SPEED) + " select * from street_speed"
Q["speed_by_increments"] = with_(*ALL, SPEED.replace(
    "from seg_streets group by", "from seg_streets where date_rome > (select min(date_rome) from seg_streets) group by")
) + " select * from street_speed"
Q["street_geometry"] = with_(*ALL, SPEED) + """
select way_id, cast(seq as integer) as vertex, from_lon as lon, from_lat as lat
from edges where way_id in (select way_id from street_speed)
union all
select way_id, cast(seq + 1 as integer), to_lon, to_lat from edges
where way_id in (select way_id from street_speed)
qualify seq = max(seq) over (partition by way_id)"""

Q["point_edge_distance"] = with_(POS, CLEAN, DEDUP, SEG, VERT, ECELLS) + """,
ecand as (
 select distinct e.way_id, e.seq as edge_seq, e.from_lat, e.from_lon, e.to_lat, e.to_lon, c.cell_lat, c.cell_lon
 from ecells c join edges e using (way_id, seq)
),
pts as (select vehicle_id, to_epoch, (from_lat + to_lat) / 2 as lat, (from_lon + to_lon) / 2 as lon from seg),
pc as (select p.*, {c_lat} + dlat as cl, {c_lon} + dlon as cn from pts p,
       (select unnest([-1, 0, 1]) as dlat) a, (select unnest([-1, 0, 1]) as dlon) b)
select distinct p.vehicle_id, p.to_epoch, e.way_id, e.edge_seq as seq, {snap_m} as snap_m
from pc p join ecand e on e.cell_lat = p.cl and e.cell_lon = p.cn""".format(
    c_lat=cell("p.lat"), c_lon=cell("p.lon"), snap_m=snap("p.lat", "p.lon"))

# all edges whose box, 25 m wider, holds the point: no grid
Q["nearest_way_exact"] = with_(POS, CLEAN, DEDUP, SEG, VERT) + """,
pts as (select vehicle_id, to_epoch, (from_lat + to_lat) / 2 as lat, (from_lon + to_lon) / 2 as lon from seg),
near as (
 select p.vehicle_id, p.to_epoch, e.way_id, {snap_m} as snap_m
 from pts p join edges e
   on p.lat between least(e.from_lat, e.to_lat) - 0.0003 and greatest(e.from_lat, e.to_lat) + 0.0003
  and p.lon between least(e.from_lon, e.to_lon) - 0.0004 and greatest(e.from_lon, e.to_lon) + 0.0004
)
select vehicle_id, to_epoch, way_id, snap_m from near where snap_m <= 25
qualify row_number() over (partition by vehicle_id, to_epoch order by snap_m, way_id) = 1""".format(
    snap_m=snap("p.lat", "p.lon"))

# ------------------------------------------------------------ quality gates
CHECK_COLS = "check_name, passed, skipped, value, threshold"

FRESH = """
fresh as (
 select 'freshness' as check_name, coalesce(lag_s <= 3600.0e0, false) as passed, false as skipped,
   cast(lag_s as double) as value, 3600.0e0 as threshold
 from (select epoch(timestamp '2024-04-04 00:30:00') - max(feed_ts) as lag_s
       from pos where cast(to_timestamp(feed_ts) as date) >= date '2024-04-03') a
)"""
COMPLETE = """
complete as (
 select 'day_completeness' as check_name, usual is null or latest >= 0.5e0 * usual as passed, usual is null as skipped,
   cast(latest as double) as value, 0.5e0 * usual as threshold
 from (select median(cnt) filter (where date_rome < date '2024-04-01') as usual,
              coalesce(sum(cnt) filter (where date_rome = date '2024-04-01'), 0) as latest
       from (select date_rome, count(*) as cnt from seg_streets
             where date_rome between date '2024-03-25' and date '2024-04-01' group by date_rome) d) a
)"""
RETAIN = """
retain as (
 select 'street_retention' as check_name, streets >= 0.9e0 * published as passed, false as skipped,
   cast(streets as double) as value, 0.9e0 * published as threshold
 from (select (select count(distinct way_id) from street_speed where hour_rome >= 2) as streets,
              (select count(distinct way_id) from street_speed where hour_rome >= 1) as published) a
)"""
Q["freshness"] = with_(POS, FRESH) + f" select {CHECK_COLS} from fresh"
Q["day_completeness"] = with_(*ALL, COMPLETE) + f" select {CHECK_COLS} from complete"
Q["street_retention"] = with_(*ALL, SPEED, RETAIN) + f" select {CHECK_COLS} from retain"
Q["checks"] = with_(*ALL, SPEED, FRESH, COMPLETE, RETAIN) + f"""
select {CHECK_COLS} from fresh union all select {CHECK_COLS} from complete union all select {CHECK_COLS} from retain"""

# days of the history, first to last, that are not loaded, from the earliest loaded on; runs of them
ISLANDS = """
loaded_days as (select distinct date_rome as day from seg where {loaded}),
open_days as (
 select cast(day as date) as day from unnest(generate_series(timestamp '{first}', cast({last} as timestamp), interval 1 day)) c(day)
 where cast(day as date) not in (select day from loaded_days)
   and cast(day as date) >= coalesce((select min(day) from loaded_days), date '{first}')),
runs as (select day, day - cast(row_number() over (order by day) as integer) as run from open_days)
"""
_RUNS = " select min(day) as start_date, max(day) as end_date from runs group by run"
Q["days_to_process"] = with_(POS, CLEAN, DEDUP, SEG, ISLANDS.format(
    loaded="date_rome <= date '2024-03-30'", first="2024-01-06", last="date '2024-04-04'")) + _RUNS
Q["days_to_process_gated"] = with_(*ALL, ISLANDS.format(
    loaded="date_rome <= date '2024-03-30'", first="2024-01-08",
    last="least(date '2024-04-06', (select max(static_date) from trip_shape) - 1)")) + _RUNS
Q["days_with_holes"] = with_(POS, CLEAN, DEDUP, SEG, ISLANDS.format(
    loaded="date_rome <= date '2024-03-31' and date_rome not in (date '2024-03-28', date '2024-03-29')",
    first="2024-01-06", last="date '2024-04-04'")) + _RUNS

# ----------------------------------------------------------------- serving
GEOM = """
geo as (
 select way_id, count(*) + 1 as vertices,
   arg_min(from_lon, seq) as lon0, arg_min(from_lat, seq) as lat0
 from edges where way_id in (select way_id from street_speed) group by way_id
),
map_view as (
 select s.*, ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][s.dow + 1] as dow_name,
   g.vertices, g.lon0, g.lat0
 from street_speed s join geo g using (way_id)
),
slots as (
 select distinct dow * 24 + hour_rome as slot from street_speed
),
best as (
 select slot // 24 as dow, slot % 24 as hour_rome from (
   select slot, ((slot - 34) % 168 + 168) % 168 as ahead from slots) a
 order by least(ahead, 168 - ahead), ahead < 168 - ahead, slot limit 1
),
slot_view as (select m.* from map_view m join best b using (dow, hour_rome))"""

Q["map_load"] = with_(*ALL, SPEED, GEOM) + """
select way_id, dow, dow_name, hour_rome, median_speed_kmh, cast(vertices as integer) as vertices, lon0, lat0 from map_view"""
Q["nearest_slot"] = with_(*ALL, SPEED, GEOM) + " select cast(dow as integer) as dow, cast(hour_rome as integer) as hour_rome from best"
Q["map_slot"] = with_(*ALL, SPEED, GEOM) + """
select way_id, dow, hour_rome, median_speed_kmh, speed_class,
  concat('rgb(', p[1], ',', p[2], ',', p[3], ')') as swatch, moving_pct
from (
 select *, [[252,206,37],[252,166,54],[242,132,75],[225,100,98],[204,71,120],[177,42,144],[143,13,164]][speed_class + 1] as p
 from (
  select *, cast(case when median_speed_kmh is null or isnan(median_speed_kmh) or median_speed_kmh <= 0 then 0
         else 1 + (median_speed_kmh > 5)::int + (median_speed_kmh > 10)::int + (median_speed_kmh > 15)::int
                + (median_speed_kmh > 20)::int + (median_speed_kmh > 30)::int end as integer) as speed_class,
    cast(round_even(moving_share * 100, 0) as integer) as moving_pct
  from slot_view) a) b"""
Q["legend_totals"] = with_(*ALL, SPEED, GEOM) + """
select cast(sum(segments) as bigint) as segments, max(days) as days, count(*) as streets from slot_view having count(*) > 0"""
Q["street_table"] = with_(*ALL, SPEED, GEOM) + """
select street, median_speed_kmh, avg_speed_kmh, moving_share, routes, vehicles, segments from slot_view"""

# ------------------------------------------------- snapshots, landing, report
Q["snapshot_time"] = with_(POS) + """
select source_file, max(feed_ts) as snapshot_epoch, count(*) as entities, true as valid from pos group by source_file"""
Q["land_if_absent"] = with_(POS) + """
select distinct feed_ts as feed_epoch, entity_id, vehicle_id, vehicle_ts as vehicle_epoch from pos
where cast(to_timestamp(feed_ts) as date) > date '2024-03-29'"""
Q["run_report"] = with_(*ALL) + """
select 'edges' as metric, cast(count(*) as double) as value from edges
union all select 'street_km', round(sum(length_m) / 1000, 3) from edges
union all select 'ways', cast(count(distinct way_id) as double) from edges
union all select 'geometries', cast(count(distinct (rep_date, rep_shape)) as double) from line_rep
union all select 'releases', cast(count(distinct static_date) as double) from trip_shape
union all select 'segments', cast(count(*) as double) from seg"""

# ------------------------------------------------ streaming, decode, sinks
Q["stream_ingest"] = with_(POS) + """
select feed_ts as feed_epoch, entity_id, vehicle_id, trip_id, route_id, lat as latitude, lon as longitude,
  vehicle_ts as vehicle_epoch, cast(to_timestamp(feed_ts) as date) as date
from pos"""
Q["decode_schedule"] = with_(SCHED) + " select * from trips where shape_id <> ''"
Q["decode_with_codec"] = Q["stream_ingest"]
Q["one_release_a_day"] = with_(SCHED) + """
select static_date, case when static_date <= date '2024-03-30' then trip_id else concat(trip_id, '-again') end as trip_id, shape_id
from trips where shape_id <> ''"""
Q["range_replace"] = with_(POS, CLEAN, DEDUP, SEG) + """,
paired30 as (select * from paired),
seg30 as (
 select vehicle_id, vehicle_ts as to_epoch, vehicle_ts - pts as duration_s,
   cast(timezone('Europe/Rome', to_timestamp(vehicle_ts)) as date) as date_rome,
   """ + haversine('plat', 'plon', 'lat', 'lon') + """ / (vehicle_ts - pts) * 3.6e0 as speed_kmh
 from paired where pts is not null and trip_id = ptrip and vehicle_ts - pts between 5 and 30
)
select vehicle_id, to_epoch, duration_s, date_rome from seg30
where speed_kmh <= 100 and date_rome not between date '2024-03-28' and date '2024-03-31'
union all
select vehicle_id, to_epoch, duration_s, date_rome from seg where date_rome between date '2024-03-28' and date '2024-03-31'"""
Q["retention_days"] = with_(POS, CLEAN, DEDUP, SEG) + """
select vehicle_id, to_epoch, date_rome from seg where date_rome >= date '2024-03-30'"""
Q["keyed_replace"] = Q["shape_streets"]
Q["partition_replace"] = Q["trip_shape"]
Q["orphan_lines"] = with_(VERT, ECELLS, SCHED, LINES) + """,
late_rep as (
 select g, static_date as rep2_date, shape_id as rep2_shape from geom where static_date >= date '2024-04-02'
 qualify row_number() over (partition by g order by static_date, shape_id) = 1
)
select l.rep2_date as rep_date, l.rep2_shape as rep_shape, s.way_id, s.points, s.span_m
from shape_streets s join geom_rep r using (rep_date, rep_shape) join late_rep l using (g)"""
Q["staged_publish"] = with_(*ALL, SPEED) + " select * from street_speed"
Q["export"] = with_(*ALL, SPEED) + """
select s.*, cast(g.n + 1 as integer) as vertices from street_speed s
join (select way_id, count(*) as n from edges group by way_id) g using (way_id)"""
