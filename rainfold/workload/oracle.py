"""DuckDB statements that state independently what each query must return."""

from __future__ import annotations

from rainfold.workload.expected_checks import EXPECTED

_METRICS = (
    "temperature_2m, relative_humidity_2m, precipitation, rain, snowfall, snow_depth, "
    "wind_speed_10m"
)
_FEED = (
    "temperature_2m_max, temperature_2m_min, temperature_2m_mean, rain_sum, precipitation_sum, "
    "snowfall_sum, sunshine_duration"
)

# Bronze tables from the events, staged tables, rollup, and the models in their written-out,
# table-by-table form.
_STEPS = {
    "bronze_hourly": """
        select 'loc_' || user_id as location_id, date_trunc('hour', ts) as observed_at,
            ts as ingested_at, ts::date as p_date,
            if(event_type = 'error', null, floor(value * 4) / 8 - 10) as temperature_2m,
            if(event_id % 17 = 0, null, (event_id % 101)::double) as relative_humidity_2m,
            case event_type when 'error' then null when 'view' then 0.0::double
                else floor(value) / 64 end as precipitation,
            case when event_type = 'error' then null
                when event_type in ('click', 'purchase') then floor(value) / 64
                else 0.0::double end as rain,
            case event_type when 'error' then null when 'signup' then floor(value) / 64
                else 0.0::double end as snowfall,
            (event_id % 9)::double / 8 as snow_depth,
            (event_id % 80)::double as wind_speed_10m
        from events""",
    "feed_days": """
        select 'loc_' || user_id as location_id, (ts + interval 3 hour)::date as p_date,
            max(floor(value * 4) / 8 - 10) as hottest,
            min(floor(value * 4) / 8 - 10) as temperature_2m_min,
            sum(floor(value * 4) / 8 - 10) / count(*) as temperature_2m_mean,
            sum(case when event_type in ('click', 'purchase', 'signup')
                then floor(value) / 64 else 0 end)::double as precipitation_sum,
            sum(case when event_type in ('click', 'purchase')
                then floor(value) / 64 else 0 end)::double as rain_sum,
            sum(case when event_type = 'signup'
                then floor(value) / 64 else 0 end)::double as snowfall_sum,
            count(*) as n
        from events group by all""",
    "bronze_daily": """
        select location_id, p_date::timestamp as date,
            p_date::timestamp + to_days(delivery) as ingested_at,
            hottest + delivery / 2.0::double - 0.5::double as temperature_2m_max,
            temperature_2m_min, temperature_2m_mean, rain_sum, precipitation_sum, snowfall_sum,
            if(day(p_date) % 5 = 0, null, n * 600.0::double) as sunshine_duration, p_date
        from feed_days, (values (0), (1)) as deliveries(delivery)""",
    "typed_daily": f"""
        select location_id, date as dates, ingested_at, p_date, {_FEED} from bronze_daily""",
    "stg_hourly": """
        select distinct on (location_id, observed_at) * from bronze_hourly
        order by location_id, observed_at, ingested_at desc nulls first""",
    "stg_daily": """
        select distinct on (location_id, dates) * from typed_daily
        order by location_id, dates, ingested_at desc nulls first""",
    # Bands as intervals: lower bound, upper bound, whether the upper bound belongs to the band.
    "bands": """
        select * from (values
            ('temp', '-infinity'::double, 0.0::double, true, 'freezing'),
            ('temp', 0, 15, true, 'cold'),
            ('temp', 15, 25, true, 'mild'),
            ('temp', 25, 'infinity', true, 'hot'),
            ('humidity', '-infinity', 30, true, 'dry'),
            ('humidity', 30, 50, true, 'mild'),
            ('humidity', 50, 60, true, 'moderately humid'),
            ('humidity', 60, 70, true, 'humid'),
            ('humidity', 70, 'infinity', true, 'very humid'),
            ('wind', '-infinity', 19, true, 'light'),
            ('wind', 19, 38, true, 'moderate'),
            ('wind', 38, 61, true, 'strong'),
            ('wind', 61, 'infinity', true, 'gale'),
            ('precipitation', '-infinity', 0.1, false, 'no precipitation'),
            ('precipitation', 0.1, 2.5, true, 'very light'),
            ('precipitation', 2.5, 7.5, true, 'light'),
            ('precipitation', 7.5, 30, true, 'moderate'),
            ('precipitation', 30, 'infinity', true, 'heavy')
        ) as b(metric, low, high, closed, label)""",
    "hourly_enriched": """
        select s.*, t.label as temp_bucket, h.label as humidity_bucket, w.label as wind_bucket,
            p.label as precipitation_bucket, precipitation > 0 as is_precipitating,
            rain > 0 as is_rain, snowfall > 0 as is_snowfall
        from stg_hourly s
        left join bands t on t.metric = 'temp'
            and temperature_2m > t.low and temperature_2m <= t.high
        left join bands h on h.metric = 'humidity'
            and relative_humidity_2m > h.low and relative_humidity_2m <= h.high
        left join bands w on w.metric = 'wind'
            and wind_speed_10m > w.low and wind_speed_10m <= w.high
        left join bands p on p.metric = 'precipitation' and case
            when not p.closed then precipitation < p.high
            when p.low = 0.1 then precipitation >= p.low and precipitation <= p.high
            else precipitation > p.low and precipitation <= p.high end""",
    "rollup": """
        select location_id, observed_at::date as dates,
            max(temperature_2m) as temperature_2m_max_from_hourly,
            min(temperature_2m) as temperature_2m_min_from_hourly,
            sum(temperature_2m) / count(temperature_2m) as temperature_2m_mean_from_hourly,
            ifnull(sum(rain), 0) as rain_sum_from_hourly,
            ifnull(sum(precipitation), 0) as precipitation_sum_from_hourly,
            ifnull(sum(snowfall), 0) as snowfall_sum_from_hourly,
            max(wind_speed_10m) as wind_speed_10m_max,
            sum(wind_speed_10m) / count(wind_speed_10m) as wind_speed_10m_mean,
            count(*) filter (precipitation > 0) as precip_hours,
            count(*) filter (rain > 0) as rain_hours,
            count(*) filter (snowfall > 0) as snowfall_hours,
            max(ingested_at) as hourly_latest_ingested_at
        from stg_hourly group by all""",
    "daily_enriched": f"""
        select d.location_id, d.dates, d.ingested_at as daily_ingested_at,
            d.p_date as daily_p_date, {_FEED}, r.* exclude (location_id, dates),
            temperature_2m_max - temperature_2m_max_from_hourly as diff_temp_max_api_vs_hourly,
            temperature_2m_min - temperature_2m_min_from_hourly as diff_temp_min_api_vs_hourly,
            precipitation_sum - precipitation_sum_from_hourly as diff_precip_api_vs_hourly
        from stg_daily d left join rollup r
            on r.location_id = d.location_id and r.dates::timestamp = d.dates""",
    "late_daily": """
        select * replace (dates + to_hours(if(day(dates) % 7 = 3, 6, 0)) as dates)
        from stg_daily""",
    "late_enriched": f"""
        select d.location_id, d.dates, d.ingested_at as daily_ingested_at,
            d.p_date as daily_p_date, {_FEED}, r.* exclude (location_id, dates),
            temperature_2m_max - temperature_2m_max_from_hourly as diff_temp_max_api_vs_hourly,
            temperature_2m_min - temperature_2m_min_from_hourly as diff_temp_min_api_vs_hourly,
            precipitation_sum - precipitation_sum_from_hourly as diff_precip_api_vs_hourly
        from late_daily d left join rollup r
            on r.location_id = d.location_id and r.dates::timestamp = d.dates""",
    "fct_daily_api": f"""
        select location_id, dates::date as dates, {_FEED} from stg_daily""",
    "fct_daily_hourly": """
        select location_id, dates,
            temperature_2m_max_from_hourly as temperature_2m_max,
            temperature_2m_min_from_hourly as temperature_2m_min,
            temperature_2m_mean_from_hourly as temperature_2m_mean,
            rain_sum_from_hourly as rain_sum,
            precipitation_sum_from_hourly as precipitation_sum,
            snowfall_sum_from_hourly as snowfall_sum,
            wind_speed_10m_max, wind_speed_10m_mean, precip_hours, rain_hours, snowfall_hours
        from rollup""",
    "fct_daily": """
        select location_id, dates,
            ifnull(h.temperature_2m_max, a.temperature_2m_max) as temperature_2m_max,
            ifnull(h.temperature_2m_min, a.temperature_2m_min) as temperature_2m_min,
            ifnull(h.temperature_2m_mean, a.temperature_2m_mean) as temperature_2m_mean,
            ifnull(h.rain_sum, a.rain_sum) as rain_sum,
            ifnull(h.precipitation_sum, a.precipitation_sum) as precipitation_sum,
            ifnull(h.snowfall_sum, a.snowfall_sum) as snowfall_sum,
            sunshine_duration, wind_speed_10m_max, wind_speed_10m_mean,
            precip_hours, rain_hours, snowfall_hours,
            if(h.temperature_2m_max is not null, 'hourly_derived',
                if(a.temperature_2m_max is not null, 'api_daily', null)) as temperature_source,
            if(h.precipitation_sum is not null, 'hourly_derived',
                if(a.precipitation_sum is not null, 'api_daily', null)) as precipitation_source,
            if(sunshine_duration is not null, 'api_daily', null) as sunshine_source
        from fct_daily_hourly h full join fct_daily_api a using (location_id, dates)""",
    "fct_daily_quality": """
        select b.location_id, b.dates,
            round(len(list_filter([b.temperature_2m_max, b.temperature_2m_min,
                b.temperature_2m_mean, b.precipitation_sum, b.rain_sum, b.snowfall_sum,
                b.sunshine_duration, b.wind_speed_10m_max],
                lambda m: m is not null)) / 8.0::double, 2) as completeness_score,
            abs(diff_temp_max_api_vs_hourly) as abs_diff_temp_max,
            abs(diff_temp_min_api_vs_hourly) as abs_diff_temp_min,
            abs(diff_precip_api_vs_hourly) as abs_diff_precip, b.precip_hours,
            case when diff_precip_api_vs_hourly is null then 'missing_hourly'
                when ifnull(abs(diff_temp_max_api_vs_hourly), 0) > 2
                    or ifnull(abs(diff_temp_min_api_vs_hourly), 0) > 2
                    or abs(diff_precip_api_vs_hourly) > 5 then 'warning'
                else 'ok' end as reconciliation_status
        from fct_daily b left join daily_enriched r
            on r.location_id = b.location_id and r.dates = b.dates::timestamp""",
    "locations": """
        select 'loc_' || n_nationkey as location_id, n_name as name,
            'R' || n_regionkey as state, 'XX' as country,
            (n_nationkey - 12)::double as latitude, (n_nationkey * 7 - 90)::double as longitude,
            'UTC' as timezone,
            [' TRUE ', 'yes', '0', 'T', 'off', null, '1'][n_nationkey % 7 + 1] as is_active
        from nation""",
    "dim_locations": """
        select location_id, name as location_name, state, country, latitude, longitude, timezone,
            case n when 0 then true when 1 then true when 2 then false when 3 then true
                when 4 then false when 6 then true end as is_active
        from locations join (select 'loc_' || n_nationkey as location_id, n_nationkey % 7 as n
            from nation) using (location_id)""",
    # Deliveries for the loads: the same readings an hour later, a day newer, half a degree up.
    "next_hour": """
        select * replace (observed_at + interval 1 hour as observed_at,
            (observed_at + interval 1 hour)::date as p_date,
            ingested_at + interval 1 day as ingested_at,
            temperature_2m + 0.5::double as temperature_2m)
        from bronze_hourly""",
    "next_hour_latest": """
        select * from next_hour
        qualify row_number() over (partition by location_id, observed_at
            order by ingested_at desc nulls first) = 1""",
}


# The hourly table after the deliveries of the incremental queries.
_STEPS["grown"] = """
        select * from stg_hourly t where not exists (select 1 from some_days b
            where b.location_id = t.location_id and b.observed_at = t.observed_at)
        union all by name select * from some_days"""
_STEPS["some_days"] = "select * from next_hour_latest where day(p_date) % 3 = 1"
# A step is found by its name, and has to come after those it names.
_STEPS["grown"] = _STEPS.pop("grown")
_STEPS["grown_rollup"] = _STEPS["rollup"].replace("stg_hourly", "grown")


def _with(query: str) -> str:
    """The steps a query names, directly or through other steps, in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(text.replace(",", " ").replace("(", " ").replace(")", " ")
                    .replace(".", " ").split())
        for step in _STEPS:
            if step in words and step not in needed:
                needed.add(step)
                visit(_STEPS[step])

    visit(query)
    steps = [f"{name} as ({text})" for name, text in _STEPS.items() if name in needed]
    return f"with {', '.join(steps)} {query}" if steps else query


def _failures(table: str, check: str, source: str) -> str:
    name = check.replace("'", "''")
    return (
        f"select '{table}' as \"table\", '{name}' as \"check\", count(*) as failures, "
        f"if(count(*) = 0, 'pass', 'fail') as status {source}"
    )


def _upserted(table: str, batch: str) -> str:
    return (
        f"select * from {table} t where not exists (select 1 from {batch} b "
        f"where b.location_id = t.location_id and b.observed_at = t.observed_at) "
        f"union all by name select * from {batch}"
    )


def _packed(unit_rows: str, unit: str, time_column: str, columns: str) -> str:
    """Rows after a trip through documents: a document's stamp is its month's newest one."""
    return f"""
        , stamps as (
            select location_id, date_trunc('month', p_date) as month,
                max(ingested_at) as stamp
            from (select location_id, p_date, ingested_at from stg_hourly
                union all select location_id, p_date, ingested_at from stg_daily)
            group by all)
        select location_id, {unit} as {time_column}, date_trunc('second', stamp) as ingested_at,
            {columns}, p_date
        from {unit_rows} s join stamps using (location_id)
        where stamps.month = date_trunc('month', s.p_date)"""


_EVENT_COLUMNS = "event_id, ts as ingested_at, user_id, event_type, value, props"

_QUERIES = {
    "typed_hourly": "select * from bronze_hourly",
    "typed_daily": "select * from typed_daily",
    "dedup_hourly_latest": "select * from stg_hourly",
    "dedup_daily_latest": "select * from stg_daily",
    "dedup_keep_last": f"""
        select {_EVENT_COLUMNS} from events
        qualify row_number() over (partition by user_id, event_type order by ts desc) = 1""",
    "hot_key_dedup": f"""
        select {_EVENT_COLUMNS} from events
        qualify row_number() over (partition by event_type order by ts desc) = 1""",
    "duplicate_count": """
        select (select count(*) from bronze_hourly)::bigint as rows_read,
            (select count(*) from stg_hourly)::bigint as rows_kept,
            ((select count(*) from bronze_hourly) - (select count(*) from stg_hourly))::bigint
                as duplicates""",
    "hourly_bands": """
        select location_id, observed_at, temp_bucket, humidity_bucket, wind_bucket,
            precipitation_bucket from hourly_enriched""",
    "hourly_flags": """
        select location_id, observed_at, is_precipitating, is_rain, is_snowfall
        from hourly_enriched""",
    "hourly_enriched": "select * from hourly_enriched",
    "daily_rollup": "select * from rollup",
    "daily_enriched": "select * from daily_enriched",
    "daily_enriched_off_midnight": "select * from late_enriched",
    "pipeline_fct_daily": "select * from fct_daily",
    "pipeline_quality": "select * from fct_daily_quality",
    "tables_by_name": """
        select f.location_id, f.dates, any_value(f.temperature_2m_max) as temperature_2m_max,
            any_value(l.location_name) as location_name, any_value(l.is_active) as is_active,
            count(h.observed_at) as hours
        from fct_daily f join dim_locations l on l.location_id = f.location_id
            left join stg_hourly h on h.location_id = f.location_id and h.p_date = f.dates
        group by f.location_id, f.dates""",
    "guard_verdicts": """
        select * from (values
            ('locations as they are', 'pass'),
            ('locations without two columns',
                'location list lacks columns: [''state'', ''timezone'']'),
            ('no location is active',
                'no active location; set is_active to true in at least one row'),
            ('batch without a key column', 'batch lacks columns: [''observed_at'']'),
            ('batch with an unknown column', 'batch has columns the table lacks: [''sleet'']'),
            ('partitioned by a metric',
                'time column must be one of [''date'', ''observed_at''], not ''rain'''),
            ('one bound of a range', 'give both start and end of a fixed range, or neither'),
            ('series of equal length', 'pass'),
            ('landing without files', 'no *.{json,jsonl,json.gz,jsonl.gz} file under')
        ) as v(guarded, outcome)
        union all select 'an active location without a place',
            if(count(*) > 0, 'an active location lacks its latitude or longitude', 'pass')
        from locations where state = 'R1' and lower(trim(is_active)) in ('true', '1', 'yes', 't')
        union all select 'rows without a time', count(distinct location_id)
            || ' rows have no observed_at; quarantine them first'
        from bronze_hourly where rain > 1
        union all select 'series one value short', 'series value has ' || (max(len(embedding)) - 1)
            || ' values for ' || max(len(embedding)) || ' times'
        from embeddings""",
    "partial_rebuild": "select * from fct_daily",
    "landing_incremental": _packed("stg_hourly", "observed_at", "observed_at", _METRICS),
    "quarantined_rows": _packed(
        "stg_hourly", "null::timestamp", "observed_at", _METRICS
    ).replace("p_date\n        from", "null::date as p_date\n        from")
    + " and hour(observed_at) = 5",
    "malformed_line_numbers": """
        select event_type as file, line, left(props, len(props) - 1) as malformed
        from (select *, row_number() over (partition by event_type order by event_id) as line
            from events)
        where event_id % 37 = 0""",
    "open_variables": """
        select location_id, observed_at, timestamp '2024-06-01' as ingested_at,
            temperature_2m, if(day(p_date) <= 18, relative_humidity_2m, null)
                as relative_humidity_2m,
            null::double as precipitation, if(day(p_date) <= 18, rain, null) as rain,
            null::double as snowfall, null::double as snow_depth,
            if(day(p_date) >= 12, wind_speed_10m, null) as wind_speed_10m,
            if(day(p_date) <= 18, wind_speed_10m * 2, null) as gusts,
            case when day(p_date) >= 12 then if(rain > 0, 'wet', 'dry') end as sky, p_date
        from stg_hourly""",
    "locations_csv": "select * from locations",
    "load_beside_reader": " union all by name ".join(
        f"select '{opened}' as opened, * from ({rows})"
        for opened, rows in {
            "before": "select * from stg_hourly",
            "during": "select * from stg_hourly",
            "after": _upserted("stg_hourly", "next_hour_latest"),
        }.items()
    ),
    "pending_during_build": """
        select distinct p_date as day from bronze_hourly
        where substring(location_id, 5)::integer % 5 = 2 and day(p_date) % 4 = 1""",
    "rollup_incremental": "select * from grown_rollup",
    "column_statistics": " union all ".join(
        f"""select '{name}' as "column", min({name})::varchar as least,
            max({name})::varchar as most, count(*) filter ({name} is null) as nulls from grown"""
        for name in ("location_id", *_METRICS.split(", "))
    ),
    "freshness_stored": """
        select 'hourly' as source, max(ingested_at) as max_loaded_at,
            case when timestamp '2024-02-10 12:00:00' - max(ingested_at) <= interval 7 day
                then 'pass'
                when timestamp '2024-02-10 12:00:00' - max(ingested_at) <= interval 30 day
                then 'warn' else 'error' end as status
        from grown""",
    "duplicate_count_stored": """
        select count(*) as rows_read, count(*) as rows_kept, 0::bigint as duplicates from grown""",
    "table_key_conflicts": """
        select location_id, observed_at, count(*) as n
        from bronze_hourly where location_id is not null and observed_at is not null
        group by all having count(*) > 1""",
    "empty_load": "select * from stg_hourly",
    "fct_daily_api": "select * from fct_daily_api",
    "fct_daily_hourly": "select * from fct_daily_hourly",
    "fct_daily": "select * from fct_daily",
    "fct_daily_bucketed": "select * from fct_daily",
    "fct_daily_ranged": """
        select * from fct_daily where dates between date '2024-01-13' and date '2024-01-20'""",
    "fct_daily_quality": "select * from fct_daily_quality",
    "quality_status_counts": """
        select reconciliation_status, count(*) as days,
            round(avg(completeness_score), 6) as mean_score
        from fct_daily_quality group by all""",
    "dim_locations": "select * from dim_locations",
    "active_locations": """
        select * replace (true as is_active) from locations
        where lower(trim(is_active)) in ('true', '1', 'yes', 'y', 't')""",
    "series_explode": """
        select vec_id, label, unnest(range(1, len(embedding) + 1))::integer as position,
            unnest(embedding)::double as value, null::double as absent
        from embeddings""",
    "json_props": """
        select event_id, (props ->> '$.k')::bigint as k,
            '{"k":' || (props ->> '$.k') || '}' as json
        from events""",
    "landing_roundtrip": _packed("stg_hourly", "observed_at", "observed_at", _METRICS),
    "landing_roundtrip_daily": _packed("stg_daily", "dates", "date", _FEED),
    "parquet_partition_roundtrip": "select * from bronze_hourly",
    "union_by_name": """
        select * from bronze_hourly union all by name select * from bronze_daily""",
    "load_replace": "select * from next_hour_latest",
    "load_append": """
        select * from stg_hourly
        union all select * replace ('alt_' || location_id as location_id) from stg_hourly""",
    "load_upsert": _upserted("stg_hourly", "next_hour_latest"),
    "load_upsert_older": _upserted("next_hour_latest", "stg_hourly"),
    "load_upsert_narrow": """
        select location_id, observed_at,
            if(b.p_date is null, t.ingested_at, b.ingested_at) as ingested_at,
            if(b.p_date is null, t.temperature_2m, b.temperature_2m) as temperature_2m,
            t.relative_humidity_2m, t.precipitation, t.rain, t.snowfall, t.snow_depth,
            t.wind_speed_10m, ifnull(t.p_date, b.p_date) as p_date
        from stg_hourly t full join next_hour_latest b using (location_id, observed_at)""",
    "check_not_null": "select * from bronze_hourly where temperature_2m is null",
    "check_unique": """
        select location_id, count(*) as n from bronze_hourly group by all having count(*) > 1""",
    "check_unique_combination": """
        select location_id, observed_at, count(*) as n
        from bronze_hourly group by all having count(*) > 1""",
    "check_accepted_values": """
        select location_id, observed_at, temp_bucket from hourly_enriched
        where temp_bucket in ('freezing', 'hot')""",
    "check_expression": """
        select * from bronze_hourly
        where temperature_2m is null or temperature_2m < -80 or temperature_2m >= 70""",
    "check_column_expression": """
        select * from rollup
        where temperature_2m_max_from_hourly < -80 or temperature_2m_max_from_hourly > 60""",
    "check_freshness": """
        select source, max_loaded_at,
            case when timestamp '2024-02-10 12:00:00' - max_loaded_at <= interval 7 day
                then 'pass'
                when timestamp '2024-02-10 12:00:00' - max_loaded_at <= interval 30 day
                then 'warn' else 'error' end as status
        from (select 'hourly' as source, max(ingested_at) as max_loaded_at from bronze_hourly
            union all select 'daily', max(ingested_at) from bronze_daily)""",
}


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, query in _QUERIES.items():
        if query.lstrip().startswith(","):
            # The query brings a step of its own.
            statements[name] = _with("select * from (" + query + ")").replace(
                "select * from (" + query + ")", query
            )
        else:
            statements[name] = _with(query)
    suite = " union all ".join(_failures(*expected) for expected in EXPECTED)
    statements["check_suite"] = _with(suite)
    statements["check_suite_incremental"] = statements["check_suite"]
    return statements
