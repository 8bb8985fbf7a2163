"""DuckDB SQL that says what each registered query must return.

It starts from the given tables, never from the messages made of them, so a
match shows that nothing was lost or changed on the way through JSON.
"""

from __future__ import annotations

from aeroflow.sources.generated import (
    CHILDREN_PER_MESSAGE,
    FIRST_SEND,
    RESEND_WAVE,
    STRAY_TOPIC,
    WAVE,
)

FLIGHTS = f"""
flights as (
  select cast(o_orderdate as date) as flight_date,
    case o_orderstatus when 'F' then 'landed' when 'O' then 'scheduled' else 'active' end as flight_status,
    'Airport ' || c_nationkey as departure_airport, 'Etc/UTC' as departure_timezone,
    case when c_nationkey = 0 then 'JFK' else 'N' || c_nationkey end as departure_iata,
    case when c_nationkey = 0 then 'KJFK' else 'KN' || c_nationkey end as departure_icao,
    cast(o_orderkey % 9 as varchar) as departure_terminal,
    case when o_orderkey % 4 <> 0 then 'G' || (o_orderkey % 30) end as departure_gate,
    late as departure_delay, due as departure_scheduled, due as departure_estimated,
    due + to_minutes(late) as departure_actual, cast(null as timestamp) as departure_estimated_runway,
    case when o_orderkey % 2 <> 0 then due + to_minutes(late) end as departure_actual_runway,
    'Airport ' || (o_orderkey % 25) as arrival_airport, 'Etc/UTC' as arrival_timezone,
    'A' || (o_orderkey % 25) as arrival_iata, 'KA' || (o_orderkey % 25) as arrival_icao,
    cast(null as varchar) as arrival_terminal, cast(null as varchar) as arrival_gate,
    case when o_orderkey % 6 = 0 then 'B' || (o_orderkey % 12) end as arrival_baggage,
    due as arrival_scheduled,
    case when o_orderkey % 3 <> 0 then cast(o_orderkey % 90 as int) end as arrival_delay,
    cast(null as timestamp) as arrival_estimated, cast(null as timestamp) as arrival_actual,
    cast(null as timestamp) as arrival_estimated_runway, cast(null as timestamp) as arrival_actual_runway,
    case when o_orderkey % 50 <> 0 then o_orderpriority end as airline_name,
    substr(o_orderpriority, 1, 1) as airline_iata, 'AL' || substr(o_orderpriority, 1, 1) as airline_icao,
    cast(o_orderkey as varchar) as flight_number, 'F' || o_orderkey as flight_iata, 'FL' || o_orderkey as flight_icao,
    case when o_orderkey % 7 = 0 then c_mktsegment end as codeshared_airline_name,
    case when o_orderkey % 7 = 0 then substr(c_mktsegment, 1, 2) end as codeshared_airline_iata,
    case when o_orderkey % 7 = 0 then substr(c_mktsegment, 1, 3) end as codeshared_airline_icao,
    case when o_orderkey % 7 = 0 then cast(o_orderkey + 1 as varchar) end as codeshared_flight_number,
    case when o_orderkey % 7 = 0 then 'C' || o_orderkey end as codeshared_flight_iata,
    case when o_orderkey % 7 = 0 then 'CS' || o_orderkey end as codeshared_flight_icao
  from (select *, case when o_orderkey % 97 <> 0 then o_orderdate + to_minutes(o_orderkey % 1440) end as due,
          case when o_orderkey % 5 <> 0 then cast(o_orderkey % 180 as int) end as late
        from orders join customer on o_custkey = c_custkey) t
)"""

# Pages of flights: one message each, as no page fills more than one message.
FLIGHT_PAGES = """
flight_pages as (
  select o_orderkey // 100 as env, count(*) as n_flights
  from orders join customer on o_custkey = c_custkey group by o_orderkey // 100
), flight_messages as (
  select env || '/0' as key, cast(env % 3 as int) as partition, env // 3 as "offset", n_flights
  from flight_pages
)"""

AIRPORTS = """
airportsint as (
  select 'ap' || s_suppkey as _id, s_name as name,
    case when s_suppkey % 2 <> 0 then 'I' || s_suppkey end as iata_code,
    case when s_suppkey % 7 <> 0 then case when s_suppkey = 1 then 'KJFK'
      else 'K' || lpad(cast(s_suppkey as varchar), 3, '0') end end as icao_code,
    cast(s_suppkey % 10 as int) as type, n_name as country,
    cast((s_suppkey * 17) % 180 - 90 as double) as latitude,
    cast((s_suppkey * 37) % 360 - 180 as double) as longitude,
    s_acctbal as elevation_value, 0 as elevation_unit, 1 as elevation_reference_datum,
    s_suppkey % 3 = 0 as ppr, s_suppkey % 5 = 0 as private,
    s_suppkey % 6 = 0 as skydive_activity, false as winch_only
  from supplier join nation on s_nationkey = n_nationkey
)"""

FREQUENCIES = """
frequencies as (
  select concat_ws('-', l_orderkey, l_partkey, l_linenumber) as _id, 'ap' || l_suppkey as airport_id,
    cast(l_extendedprice as decimal(18,2)) as value, 2 as unit, l_linenumber as type,
    l_returnflag as name, l_linenumber = 1 as primary_freq, l_linestatus = 'F' as public_use
  from lineitem join supplier on l_suppkey = s_suppkey where l_suppkey % 9 <> 0
)"""

RUNWAYS = """
runways as (
  select concat_ws('-', l_orderkey, l_partkey) as _id, 'ap' || l_suppkey as airport_id,
    lpad(cast(cast(l_quantity as int) as varchar), 2, '0') as designator,
    l_returnflag = 'A' as take_off_only, l_returnflag = 'R' as landing_only,
    l_linestatus = 'F' as pilot_ctrl_lighting, cast(l_quantity as int) as surface_main,
    l_quantity as length, case when l_tax <> 0 then l_quantity end as width
  from lineitem join supplier on l_suppkey = s_suppkey where l_linenumber = 1 and l_suppkey % 8 <> 0
)"""

# Airport messages: one per page of children, every tenth airport sent again.
AIRPORT_MESSAGES = f"""
children as (
  select l_suppkey, count(*) as n from lineitem group by l_suppkey
), sends as (
  select s_suppkey, unnest(range(coalesce((n + {CHILDREN_PER_MESSAGE - 1}) // {CHILDREN_PER_MESSAGE}, 1))) as page,
    0 as send
  from supplier join nation on s_nationkey = n_nationkey left join children on l_suppkey = s_suppkey
), airport_messages as (
  select s_suppkey, cast(s_suppkey % 3 as int) as partition,
    (send * {RESEND_WAVE} + page) * {WAVE} + s_suppkey // 3 as "offset"
  from (select * from sends union all select s_suppkey, page, 1 from sends where s_suppkey % 10 = 0)
)"""

FREQUENCY_ROWS = """select _id, airport_id, cast(value as double) as value, unit, type, name,
  primary_freq, public_use from frequencies"""

TOTALS = """(select airport_id, sum(value) as total_value from frequencies group by airport_id)"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


def _share(column: str) -> str:
    return f"""select {column}, n, n * 1.0e0 / t as share
from (select {column}, count(*) as n from flights where departure_iata = 'JFK' group by {column})
cross join (select count(*) as t from flights where departure_iata = 'JFK')"""


STRAY_ROWS = f"""select '{STRAY_TOPIC}' as topic, cast(event_id % 3 as int) as partition,
  event_id // 3 as "offset", props as raw, 'missing_id' as reason from events
union all
select '{STRAY_TOPIC}', cast(event_id % 3 as int), event_id // 3, event_type, 'malformed' from events"""

DAILY_DELAY = """(select flight_date, avg(departure_delay) as avg_delay from flights
  where departure_iata = 'JFK' and departure_delay is not null group by flight_date)"""

_FLIGHT_SQL = {
    "flights_flatten": "select * from flights",
    "flights_timestamps": """select flight_iata, departure_scheduled, departure_actual,
  arrival_scheduled, arrival_estimated from flights""",
    "flights_raw_json": """select flight_iata, flight_iata as raw_flight_iata, departure_gate as raw_gate,
  case when cast(flight_number as bigint) % 11 = 0 then '{"iata":"B738"}' end as raw_aircraft from flights""",
    "flights_codeshare": """select codeshared_airline_name, count(*) as n, avg(arrival_delay) as avg_delay
  from flights group by codeshared_airline_name""",
    "departures_per_day": """select flight_date, count(*) as n_flights from flights
  where departure_iata = 'JFK' group by flight_date order by flight_date asc nulls last""",
    "avg_departure_delay": f"select flight_date, avg_delay from {DAILY_DELAY} order by flight_date asc nulls last",
    "avg_arrival_delay": """select avg(arrival_delay) as delay_minutes, 'min' as unit from flights
  where departure_iata = 'JFK'""",
    "literal_relation": """select 22 as delay_minutes, 'min' as unit, avg(arrival_delay) as measured_minutes
  from flights where departure_iata = 'JFK'""",
    "top_destinations": """select arrival_airport, count(*) as n_flights from flights
  where departure_iata = 'JFK' group by arrival_airport
  order by n_flights desc nulls first, arrival_airport asc nulls last limit 5""",
    "flights_by_airline": """select airline_name, count(*) as n_flights from flights
  where departure_iata = 'JFK' group by airline_name
  order by n_flights desc nulls first, airline_name asc nulls last""",
    "flights_by_status": """select flight_status, count(*) as n_flights from flights
  where departure_iata = 'JFK' group by flight_status""",
    "status_airline_stats": """select flight_status, count(*) as n_flights,
  count(distinct airline_name) as n_airlines from flights group by flight_status""",
    "latest_flights": """select flight_date, flight_iata, airline_name, arrival_airport, departure_scheduled,
  departure_actual, departure_delay, flight_status from flights where departure_iata = 'JFK'
  order by departure_scheduled desc nulls first, flight_iata limit 20""",
    "distinct_destinations": "select distinct arrival_airport from flights where departure_iata = 'JFK'",
    "distinct_airlines": "select distinct airline_name from flights where departure_iata = 'JFK'",
    "latest_day_kpi": """select max_by(n, flight_date) as n_flights,
  max_by(d, flight_date) filter (where d is not null) as avg_delay
  from (select flight_date, count(*) as n, avg(departure_delay) as d from flights
    where departure_iata = 'JFK' group by flight_date)""",
    "delay_bands": f"""select flight_date, avg_delay,
  case when avg_delay >= 80 then 'red' else 'green' end as band from {DAILY_DELAY}""",
    "percentage_bands": f"""select flight_date, avg_delay,
  case when mx > mn and (avg_delay - mn) / (mx - mn) * 100 >= 80 then 'red' else 'green' end as band
from {DAILY_DELAY} cross join (select min(avg_delay) as mn, max(avg_delay) as mx from {DAILY_DELAY})""",
    "display_names": """select flight_date as time, count(*) as "Vols au départ de JFK" from flights
  where departure_iata = 'JFK' group by flight_date""",
    "delay_alerts": f"select flight_date, avg_delay from {DAILY_DELAY} where avg_delay >= 80",
    "airline_share": _share("airline_name"),
    "status_share": _share("flight_status"),
    "filter_multi_select": """select flight_iata, arrival_airport, airline_name from flights
  where departure_iata = 'JFK' and airline_name in ('1-URGENT', '5-LOW')""",
    "filter_all_selected": """select flight_iata, arrival_airport, airline_name from flights
  where departure_iata = 'JFK' and arrival_airport in ('Airport 3', 'Airport 7')""",
    "filter_time_range": """select flight_iata, departure_scheduled from flights where departure_scheduled
  between timestamp '1998-01-01 00:00:00' and timestamp '1998-02-01 00:00:00'""",
    "json_split": """select (cast(flight_number as bigint) // 100) || '/0' as page_key, flight_iata,
  flight_status as status from flights""",
    "variant_split": """select (cast(flight_number as bigint) // 100) || '/0' as page_key, flight_iata,
  flight_status as status from flights""",
    "json_normalize": """select '{"flight":"' || flight_iata || '","icao":"' || departure_icao
  || '","name":"' || departure_airport || '"' || coalesce(',"gate":"' || departure_gate || '"', '')
  || '}' as record from flights""",
    "publish_records": "select * from flights",
    "stream_flights_ingest": "select * from flights",
}
_FLIGHT_SQL["compacted_flights"] = _FLIGHT_SQL["flights_flatten"]
_FLIGHT_SQL["compacted_versions"] = """select version, flight_status, count(*) as n_flights
  from flights cross join (select unnest(['batches', 'version 1']) as version) group by version, flight_status"""
_FLIGHT_SQL["live_departures_per_day"] = _FLIGHT_SQL["departures_per_day"]
_FLIGHT_SQL["live_avg_departure_delay"] = _FLIGHT_SQL["avg_departure_delay"]
_FLIGHT_SQL["live_flights_by_status"] = _FLIGHT_SQL["flights_by_status"]
_FLIGHT_SQL["live_status_stats"] = """select flight_status, count(*) as n_flights,
  count(distinct airline_name) as n_airlines, true as close from flights group by flight_status"""
_FLIGHT_SQL["stream_top_destinations"] = _FLIGHT_SQL["top_destinations"]
_FLIGHT_SQL["stream_time_range"] = _FLIGHT_SQL["filter_time_range"]

_AIRPORT_SQL = {
    "airports_flatten": "select * from airportsint",
    "airports_dedup": "select _id, name from airportsint",
    "airports_clean": "select _id, icao_code, latitude, longitude from airportsint where icao_code is not null",
    "airports_bbox": """select name, latitude, longitude from airportsint
  where latitude between 40.0 and 50.0 and longitude between -5.0 and 180.0""",
    "positions_bbox": """select name, latitude, longitude from airportsint
  where latitude >= 40.0 and latitude <= 50.0 and longitude >= -5.0 and longitude <= 180.0""",
    "positions_over_date_line": """select name, latitude, longitude from airportsint
  where abs(latitude) <= 60.0 and (longitude >= 100.0 or longitude <= -20.0)""",
    "airports_reference_box": """select name, latitude, longitude from airportsint
  where latitude between 40.0 and 50.0 and longitude between -5.0 and 10.0""",
    "enriched_airports": """select _id, icao_code, 0 as geoid_height, 0 as hae, 'spark' as created_by,
  'spark' as updated_by, 1 as v_version, cast(null as double) as magnetic_declination, 0 as n_traffic_types
  from airportsint where icao_code is not null""",
    "airport_geo_points": """select name, latitude, longitude from airportsint
  where latitude is not null and icao_code is not null and icao_code like '%JFK%'""",
    "airports_by_country": """select country, count(*) as nb_airports from airportsint group by country
  order by nb_airports desc nulls first, country asc nulls last limit 10""",
    "distinct_airport_ids": "select distinct _id from airportsint order by _id asc nulls last",
    "airport_names": "select name from airportsint",
    "stream_airports_ingest": "select * from airportsint",
    "stream_current_airports": "select _id, name from airportsint",
}

_FREQUENCY_SQL = {
    "frequencies_explode": FREQUENCY_ROWS,
    "stream_frequencies_ingest": FREQUENCY_ROWS,
    "uncastable_values": """select 'value' as column_name, count(value) as present, cast(0 as bigint) as uncastable
  from frequencies
union all select 'name', count(name), count(name) from frequencies""",
    "total_value": "select cast(sum(value) as double) as total_value from frequencies",
    "value_by_airport": "select airport_id, cast(sum(value) as double) as total_value from frequencies group by airport_id",
}

_RUNWAY_SQL = {
    "runways_explode": "select * from runways",
    "stream_runways_ingest": "select * from runways",
}

_BY_COUNTRY = """select country, cast(sum(value) as double) as total_value_country
  from frequencies join airportsint on airport_id = airportsint._id group by country
  order by total_value_country desc nulls first, country asc nulls last"""

_BY_NAME = """select airportsint.name, cast(sum(value) as double) as total_value
  from frequencies join airportsint on airport_id = airportsint._id group by airport_id, airportsint.name
  order by total_value desc nulls first, airportsint.name asc nulls last"""

_JOINED_SQL = {
    "value_by_country": _BY_COUNTRY,
    "top_countries": f"{_BY_COUNTRY} limit 15",
    "ranked_airports": _BY_NAME,
    "top_airports": f"{_BY_NAME} limit 15",
    "airport_heatmap": f"""select _id, name, latitude, longitude, total_value,
  case when mx = mn then 0e0 else (total_value - mn) / (mx - mn) end as weight
  from (select airport_id, cast(sum(value) as double) as total_value from frequencies group by airport_id)
  join airportsint on airport_id = _id
  cross join (select cast(min(total_value) as double) as mn, cast(max(total_value) as double) as mx from {TOTALS})""",
}

_MESSAGE_SQL = {
    "stream_lag": _with(AIRPORT_MESSAGES)
    + """select moment, 'airports' as topic, partition, case when moment = 'after' then max("offset") end as read_offset,
  max("offset") as latest_offset, case when moment = 'after' then 0 else count(*) end as lag
  from airport_messages cross join (select unnest(['before', 'after']) as moment) group by moment, partition""",
    "republished_topic": _with(AIRPORTS)
    + """, sent as (
  select _id, cast(('0x' || substr(md5(_id), 1, 15))::bigint % 3 as int) as partition from airportsint
), counted as (
  select partition, 2 * count(*) as n, count(*) as airports from sent group by partition
)
select 'names' as topic, partition, case when partition = 1 then n - 1 else n end as messages,
  case when partition = 1 then 1 else 0 end as first_offset, n - 1 as last_offset,
  case when partition = 1 then n - 1 else n end as offsets, airports from counted""",
    "long_amounts": """with sums as (
  select l_returnflag, sum(case when l_linenumber % 3 = 0 then -1 else 1 end * l_orderkey)::hugeint * 100000000000000000 as whole,
    sum(case when l_linenumber % 3 = 0 then -1 else 1 end * l_partkey)::hugeint as parts
  from lineitem group by l_returnflag
), scaled as (
  select l_returnflag, abs(whole * 1000000000000 + parts) as total, whole * 1000000000000 + parts < 0 as negative from sums
)
select l_returnflag, case when negative then '-' else '' end || (total // 1000000000000)::varchar || '.'
  || rpad(rtrim(lpad((total % 1000000000000)::varchar, 12, '0'), '0'), greatest(8, length(rtrim(lpad((total % 1000000000000)::varchar, 12, '0'), '0')))::int, '0') as total
from scaled""",
    "airports_parse": _with(AIRPORTS, AIRPORT_MESSAGES)
    + """select _id, name, icao_code as "icaoCode", iata_code as "iataCode", type, country, ppr, private,
  skydive_activity as "skydiveActivity", winch_only as "winchOnly", latitude, longitude, elevation_value
  from airport_messages join airportsint on _id = 'ap' || s_suppkey""",
    "batch_counts": _with(AIRPORTS, FREQUENCIES, RUNWAYS)
    + """select (select count(*) from airportsint) as airports, (select count(*) from frequencies) as frequencies,
  (select count(*) from runways) as runways""",
    "json_path_extract": "select event_id, props::json->>'k' as k from events",
    "variant_paths": """select event_id, props::json->>'k' as k, cast(props::json->>'k' as bigint) as number,
  cast(null as varchar) as missing from events""",
    "variant_shapes": """select is_json, count(*) as n from (
  select json_valid(props) as is_json from events union all select json_valid(event_type) from events
) group by is_json""",
    "reject_reasons": f"""select '{STRAY_TOPIC}' as topic, cast(event_id % 3 as int) as partition, event_id // 3 as "offset",
  case event_id % 6 when 1 then '  ' when 2 then '{{' || props when 3 then '{{"data":[],"of":' || event_id || '}}'
    when 4 then '{{"data":[{{"flight":{{"iata":"E' || event_id || '"}},"flight_status":"sent"}},17,{{"departure":{{"delay":"late"}},"flight":{{"iata":"F' || event_id || '"}}}}]}}'
  end as raw,
  case event_id % 6 when 0 then 'empty' when 1 then 'empty' when 2 then 'malformed' when 3 then 'no_flights' else 'bad_field' end as reason
  from events where event_id % 6 < 5""",
    "kept_of_broken_pages": """select 'E' || event_id as flight_iata, case event_id % 6 when 4 then 'sent' else event_type end as flight_status
  from events where event_id % 6 >= 4
union all select 'F' || event_id, null from events where event_id % 6 = 4""",
    "landed_pages": _with(FLIGHT_PAGES)
    + """select 'pages' as topic, cast(0 as int) as partition, count(*) as pages, cast(0 as bigint) as first_offset,
  count(*) - 1 as last_offset, count(*) as offsets, cast(sum(n_flights) as bigint) as flights from flight_messages""",
    "json_rewrite": """select event_id, '{"k":' || (props::json->>'k') || '}' as record from events""",
    "topic_peek": _with(FLIGHT_PAGES)
    + """select key, partition, "offset", n_flights from flight_messages order by partition, "offset" limit 5""",
    "replay_from_offset": _with(FLIGHT_PAGES)
    + """select key, partition, "offset", n_flights from flight_messages
  where (partition = 0 and "offset" >= 20) or (partition = 1 and "offset" >= 40) or partition = 2""",
    "ingest_audit": _with(FLIGHT_PAGES, AIRPORT_MESSAGES)
    + """select 'flights' as topic, partition, min("offset") as first_offset, max("offset") as last_offset,
  count(*) as messages, cast(sum(n_flights) as bigint) as records, cast(0 as bigint) as rejects
  from flight_messages group by partition
union all
select 'airports', partition, min("offset"), max("offset"), count(*), count(*), cast(0 as bigint)
  from airport_messages group by partition""",
    "quarantine": STRAY_ROWS,
    "stream_rejects": STRAY_ROWS,
    "stream_airport_freshness": _with(AIRPORT_MESSAGES)
    + f"""select 'ap' || s_suppkey as airport_id,
  make_timestamp(cast({FIRST_SEND} + max("offset" // {WAVE}) as bigint) * 1000000) as latest
  from airport_messages group by s_suppkey""",
    "stream_ingest_audit": _with(
        AIRPORT_MESSAGES,
        """
rows_sent as (
  select cast(s_suppkey % 3 as int) as partition,
    sum(case when s_suppkey % 10 = 0 then 2 else 1 end * case when s_suppkey % 9 = 0 then 0 else 1 end) as frequencies,
    sum(case when s_suppkey % 10 = 0 then 2 else 1 end
      * case when s_suppkey % 8 <> 0 and l_linenumber = 1 then 1 else 0 end) as runways
  from supplier join lineitem on l_suppkey = s_suppkey group by s_suppkey % 3
)""",
    )
    + """select 'airports' as topic, m.partition, count(*) as messages, count(distinct s_suppkey) as airports,
  cast(any_value(frequencies) as bigint) as frequencies, cast(any_value(runways) as bigint) as runways,
  cast(0 as bigint) as rejects
  from airport_messages m join rows_sent r on m.partition = r.partition group by m.partition""",
    "stream_table_counts": _with(AIRPORTS, FREQUENCIES, RUNWAYS)
    + """select 'airports' as table_name, count(*) as n from airportsint
union all select 'frequencies', sum(case when l_suppkey % 10 = 0 then 2 else 1 end) from frequencies
  join (select distinct l_suppkey from lineitem) on airport_id = 'ap' || l_suppkey
union all select 'runways', sum(case when l_suppkey % 10 = 0 then 2 else 1 end) from runways
  join (select distinct l_suppkey from lineitem) on airport_id = 'ap' || l_suppkey
union all select 'flights', count(*) from orders join customer on o_custkey = c_custkey""",
    "data_freshness": _with(AIRPORT_MESSAGES)
    + f"""select make_timestamp(cast({FIRST_SEND} + max("offset" // {WAVE}) as bigint) * 1000000) as latest
  from airport_messages""",
    "freshness_by_airport": _with(AIRPORT_MESSAGES)
    + f"""select 'ap' || s_suppkey as airport_id,
  make_timestamp(cast({FIRST_SEND} + max("offset" // {WAVE}) as bigint) * 1000000) as latest
  from airport_messages group by s_suppkey""",
}


def oracle_sql() -> dict[str, str]:
    groups = (
        ((FLIGHTS,), _FLIGHT_SQL),
        ((AIRPORTS,), _AIRPORT_SQL),
        ((FREQUENCIES,), _FREQUENCY_SQL),
        ((RUNWAYS,), _RUNWAY_SQL),
        ((AIRPORTS, FREQUENCIES), _JOINED_SQL),
    )
    prefixed = {
        name: _with(*tables) + sql for tables, queries in groups for name, sql in queries.items()
    }
    return prefixed | _MESSAGE_SQL
