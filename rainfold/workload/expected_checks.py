"""What the declared checks are expected to be: table, name and the rows that fail, as DuckDB SQL.

Stated once more, apart from the code that declares and runs them: a check that is lost, or a bound
that changes, differs from this list.
"""

# Fixed values.
EXPECTED = (
    (
        'stg_daily',
        'not_null location_id',
        'from stg_daily where location_id is null',
    ),
    (
        'stg_daily',
        'not_null dates',
        'from stg_daily where dates is null',
    ),
    (
        'stg_daily',
        'not_null p_date',
        'from stg_daily where p_date is null',
    ),
    (
        'stg_daily',
        'not_null ingested_at',
        'from stg_daily where ingested_at is null',
    ),
    (
        'stg_hourly',
        'not_null location_id',
        'from stg_hourly where location_id is null',
    ),
    (
        'stg_hourly',
        'not_null observed_at',
        'from stg_hourly where observed_at is null',
    ),
    (
        'stg_hourly',
        'not_null ingested_at',
        'from stg_hourly where ingested_at is null',
    ),
    (
        'stg_hourly',
        'not_null p_date',
        'from stg_hourly where p_date is null',
    ),
    (
        'hourly_enriched',
        'not_null location_id',
        'from hourly_enriched where location_id is null',
    ),
    (
        'hourly_enriched',
        'not_null observed_at',
        'from hourly_enriched where observed_at is null',
    ),
    (
        'hourly_enriched',
        'not_null p_date',
        'from hourly_enriched where p_date is null',
    ),
    (
        'daily_enriched',
        'not_null location_id',
        'from daily_enriched where location_id is null',
    ),
    (
        'daily_enriched',
        'not_null dates',
        'from daily_enriched where dates is null',
    ),
    (
        'daily_enriched',
        'not_null daily_ingested_at',
        'from daily_enriched where daily_ingested_at is null',
    ),
    (
        'daily_enriched',
        'not_null daily_p_date',
        'from daily_enriched where daily_p_date is null',
    ),
    (
        'dim_locations',
        'not_null location_id',
        'from dim_locations where location_id is null',
    ),
    (
        'dim_locations',
        'not_null location_name',
        'from dim_locations where location_name is null',
    ),
    (
        'dim_locations',
        'not_null is_active',
        'from dim_locations where is_active is null',
    ),
    (
        'fct_daily_api',
        'not_null location_id',
        'from fct_daily_api where location_id is null',
    ),
    (
        'fct_daily_api',
        'not_null dates',
        'from fct_daily_api where dates is null',
    ),
    (
        'fct_daily_hourly',
        'not_null location_id',
        'from fct_daily_hourly where location_id is null',
    ),
    (
        'fct_daily_hourly',
        'not_null dates',
        'from fct_daily_hourly where dates is null',
    ),
    (
        'fct_daily',
        'not_null location_id',
        'from fct_daily where location_id is null',
    ),
    (
        'fct_daily',
        'not_null dates',
        'from fct_daily where dates is null',
    ),
    (
        'fct_daily_quality',
        'not_null location_id',
        'from fct_daily_quality where location_id is null',
    ),
    (
        'fct_daily_quality',
        'not_null dates',
        'from fct_daily_quality where dates is null',
    ),
    (
        'dim_locations',
        'unique location_id',
        'from (select location_id from dim_locations where location_id is not null group by 1 having count(*) > 1)',
    ),
    (
        'stg_daily',
        'unique_combination location_id+dates',
        'from (select location_id, dates from stg_daily group by all having count(*) > 1)',
    ),
    (
        'stg_hourly',
        'unique_combination location_id+observed_at',
        'from (select location_id, observed_at from stg_hourly group by all having count(*) > 1)',
    ),
    (
        'hourly_enriched',
        'unique_combination location_id+observed_at',
        'from (select location_id, observed_at from hourly_enriched group by all having count(*) > 1)',
    ),
    (
        'daily_enriched',
        'unique_combination location_id+dates',
        'from (select location_id, dates from daily_enriched group by all having count(*) > 1)',
    ),
    (
        'fct_daily_api',
        'unique_combination location_id+dates',
        'from (select location_id, dates from fct_daily_api group by all having count(*) > 1)',
    ),
    (
        'fct_daily_hourly',
        'unique_combination location_id+dates',
        'from (select location_id, dates from fct_daily_hourly group by all having count(*) > 1)',
    ),
    (
        'fct_daily',
        'unique_combination location_id+dates',
        'from (select location_id, dates from fct_daily group by all having count(*) > 1)',
    ),
    (
        'fct_daily_quality',
        'unique_combination location_id+dates',
        'from (select location_id, dates from fct_daily_quality group by all having count(*) > 1)',
    ),
    (
        'fct_daily',
        'accepted_values temperature_source hourly_derived|api_daily',
        "from fct_daily where temperature_source not in ('hourly_derived', 'api_daily')",
    ),
    (
        'fct_daily',
        'accepted_values precipitation_source hourly_derived|api_daily',
        "from fct_daily where precipitation_source not in ('hourly_derived', 'api_daily')",
    ),
    (
        'fct_daily',
        'accepted_values sunshine_source api_daily',
        "from fct_daily where sunshine_source not in ('api_daily')",
    ),
    (
        'fct_daily_quality',
        'accepted_values reconciliation_status ok|warning|missing_hourly',
        "from fct_daily_quality where reconciliation_status not in ('ok', 'warning', 'missing_hourly')",
    ),
    (
        'fct_daily',
        'expression temperature_source is not null or precipitation_source is not null or sunshine_source is not null',
        'from fct_daily where not (temperature_source is not null or precipitation_source is not null or sunshine_source is not null)',
    ),
    (
        'stg_daily',
        'expression temperature_2m_max is not null and temperature_2m_max >= -80 and temperature_2m_max < 70',
        'from stg_daily where not (temperature_2m_max is not null and temperature_2m_max >= -80 and temperature_2m_max < 70)',
    ),
    (
        'stg_daily',
        'expression temperature_2m_min is not null and temperature_2m_min >= -80 and temperature_2m_min < 70',
        'from stg_daily where not (temperature_2m_min is not null and temperature_2m_min >= -80 and temperature_2m_min < 70)',
    ),
    (
        'stg_daily',
        'expression temperature_2m_mean is not null and temperature_2m_mean >= -80 and temperature_2m_mean < 70',
        'from stg_daily where not (temperature_2m_mean is not null and temperature_2m_mean >= -80 and temperature_2m_mean < 70)',
    ),
    (
        'stg_daily',
        'expression rain_sum is null or rain_sum >= 0',
        'from stg_daily where not (rain_sum is null or rain_sum >= 0)',
    ),
    (
        'stg_daily',
        'expression precipitation_sum is null or precipitation_sum >= 0',
        'from stg_daily where not (precipitation_sum is null or precipitation_sum >= 0)',
    ),
    (
        'stg_daily',
        'expression snowfall_sum is null or snowfall_sum >= 0',
        'from stg_daily where not (snowfall_sum is null or snowfall_sum >= 0)',
    ),
    (
        'stg_daily',
        'expression sunshine_duration is null or sunshine_duration >= 0',
        'from stg_daily where not (sunshine_duration is null or sunshine_duration >= 0)',
    ),
    (
        'stg_hourly',
        'expression temperature_2m is not null and temperature_2m >= -80 and temperature_2m < 70',
        'from stg_hourly where not (temperature_2m is not null and temperature_2m >= -80 and temperature_2m < 70)',
    ),
    (
        'stg_hourly',
        'expression relative_humidity_2m is null or relative_humidity_2m >= 0',
        'from stg_hourly where not (relative_humidity_2m is null or relative_humidity_2m >= 0)',
    ),
    (
        'stg_hourly',
        'expression precipitation is null or precipitation >= 0',
        'from stg_hourly where not (precipitation is null or precipitation >= 0)',
    ),
    (
        'stg_hourly',
        'expression rain is null or rain >= 0',
        'from stg_hourly where not (rain is null or rain >= 0)',
    ),
    (
        'stg_hourly',
        'expression snowfall is null or snowfall >= 0',
        'from stg_hourly where not (snowfall is null or snowfall >= 0)',
    ),
    (
        'stg_hourly',
        'expression snow_depth is null or snow_depth >= 0',
        'from stg_hourly where not (snow_depth is null or snow_depth >= 0)',
    ),
    (
        'stg_hourly',
        'expression wind_speed_10m is null or wind_speed_10m >= 0',
        'from stg_hourly where not (wind_speed_10m is null or wind_speed_10m >= 0)',
    ),
    (
        'hourly_enriched',
        'accepted_values temp_bucket freezing|cold|mild|hot',
        "from hourly_enriched where temp_bucket not in ('freezing', 'cold', 'mild', 'hot')",
    ),
    (
        'hourly_enriched',
        'accepted_values humidity_bucket dry|mild|moderately humid|humid|very humid',
        "from hourly_enriched where humidity_bucket not in ('dry', 'mild', 'moderately humid', 'humid', 'very humid')",
    ),
    (
        'hourly_enriched',
        'accepted_values wind_bucket light|moderate|strong|gale',
        "from hourly_enriched where wind_bucket not in ('light', 'moderate', 'strong', 'gale')",
    ),
    (
        'hourly_enriched',
        'accepted_values precipitation_bucket no precipitation|very light|light|moderate|heavy',
        "from hourly_enriched where precipitation_bucket not in ('no precipitation', 'very light', 'light', 'moderate', 'heavy')",
    ),
    (
        'hourly_enriched',
        'expression (precipitation is null and is_precipitating is null) or (precipitation > 0 and is_precipitating) or (precipitation <= 0 and not is_precipitating)',
        'from hourly_enriched where not ((precipitation is null and is_precipitating is null) or (precipitation > 0 and is_precipitating) or (precipitation <= 0 and not is_precipitating))',
    ),
    (
        'hourly_enriched',
        'expression (rain is null and is_rain is null) or (rain > 0 and is_rain) or (rain <= 0 and not is_rain)',
        'from hourly_enriched where not ((rain is null and is_rain is null) or (rain > 0 and is_rain) or (rain <= 0 and not is_rain))',
    ),
    (
        'hourly_enriched',
        'expression (snowfall is null and is_snowfall is null) or (snowfall > 0 and is_snowfall) or (snowfall <= 0 and not is_snowfall)',
        'from hourly_enriched where not ((snowfall is null and is_snowfall is null) or (snowfall > 0 and is_snowfall) or (snowfall <= 0 and not is_snowfall))',
    ),
    (
        'hourly_enriched',
        "expression (temperature_2m is null and temp_bucket is null) or (temperature_2m <= 0 and temp_bucket = 'freezing') or (temperature_2m > 0 and temperature_2m <= 15 and temp_bucket = 'cold') or (temperature_2m > 15 and temperature_2m <= 25 and temp_bucket = 'mild') or (temperature_2m > 25 and temp_bucket = 'hot')",
        "from hourly_enriched where not ((temperature_2m is null and temp_bucket is null) or (temperature_2m <= 0 and temp_bucket = 'freezing') or (temperature_2m > 0 and temperature_2m <= 15 and temp_bucket = 'cold') or (temperature_2m > 15 and temperature_2m <= 25 and temp_bucket = 'mild') or (temperature_2m > 25 and temp_bucket = 'hot'))",
    ),
    (
        'hourly_enriched',
        "expression (relative_humidity_2m is null and humidity_bucket is null) or (relative_humidity_2m <= 30 and humidity_bucket = 'dry') or (relative_humidity_2m > 30 and relative_humidity_2m <= 50 and humidity_bucket = 'mild') or (relative_humidity_2m > 50 and relative_humidity_2m <= 60 and humidity_bucket = 'moderately humid') or (relative_humidity_2m > 60 and relative_humidity_2m <= 70 and humidity_bucket = 'humid') or (relative_humidity_2m > 70 and humidity_bucket = 'very humid')",
        "from hourly_enriched where not ((relative_humidity_2m is null and humidity_bucket is null) or (relative_humidity_2m <= 30 and humidity_bucket = 'dry') or (relative_humidity_2m > 30 and relative_humidity_2m <= 50 and humidity_bucket = 'mild') or (relative_humidity_2m > 50 and relative_humidity_2m <= 60 and humidity_bucket = 'moderately humid') or (relative_humidity_2m > 60 and relative_humidity_2m <= 70 and humidity_bucket = 'humid') or (relative_humidity_2m > 70 and humidity_bucket = 'very humid'))",
    ),
    (
        'hourly_enriched',
        "expression (wind_speed_10m is null and wind_bucket is null) or (wind_speed_10m <= 19 and wind_bucket = 'light') or (wind_speed_10m > 19 and wind_speed_10m <= 38 and wind_bucket = 'moderate') or (wind_speed_10m > 38 and wind_speed_10m <= 61 and wind_bucket = 'strong') or (wind_speed_10m > 61 and wind_bucket = 'gale')",
        "from hourly_enriched where not ((wind_speed_10m is null and wind_bucket is null) or (wind_speed_10m <= 19 and wind_bucket = 'light') or (wind_speed_10m > 19 and wind_speed_10m <= 38 and wind_bucket = 'moderate') or (wind_speed_10m > 38 and wind_speed_10m <= 61 and wind_bucket = 'strong') or (wind_speed_10m > 61 and wind_bucket = 'gale'))",
    ),
    (
        'hourly_enriched',
        "expression (precipitation is null and precipitation_bucket is null) or (precipitation < 0.1 and precipitation_bucket = 'no precipitation') or (precipitation >= 0.1 and precipitation <= 2.5 and precipitation_bucket = 'very light') or (precipitation > 2.5 and precipitation <= 7.5 and precipitation_bucket = 'light') or (precipitation > 7.5 and precipitation <= 30 and precipitation_bucket = 'moderate') or (precipitation > 30 and precipitation_bucket = 'heavy')",
        "from hourly_enriched where not ((precipitation is null and precipitation_bucket is null) or (precipitation < 0.1 and precipitation_bucket = 'no precipitation') or (precipitation >= 0.1 and precipitation <= 2.5 and precipitation_bucket = 'very light') or (precipitation > 2.5 and precipitation <= 7.5 and precipitation_bucket = 'light') or (precipitation > 7.5 and precipitation <= 30 and precipitation_bucket = 'moderate') or (precipitation > 30 and precipitation_bucket = 'heavy'))",
    ),
    (
        'daily_enriched',
        'column_expression rain_sum_from_hourly >= 0',
        'from daily_enriched where not (rain_sum_from_hourly >= 0)',
    ),
    (
        'daily_enriched',
        'column_expression precipitation_sum_from_hourly >= 0',
        'from daily_enriched where not (precipitation_sum_from_hourly >= 0)',
    ),
    (
        'daily_enriched',
        'column_expression snowfall_sum_from_hourly >= 0',
        'from daily_enriched where not (snowfall_sum_from_hourly >= 0)',
    ),
    (
        'daily_enriched',
        'column_expression precip_hours between 0 and 24',
        'from daily_enriched where not (precip_hours between 0 and 24)',
    ),
    (
        'daily_enriched',
        'column_expression rain_hours between 0 and 24',
        'from daily_enriched where not (rain_hours between 0 and 24)',
    ),
    (
        'daily_enriched',
        'column_expression snowfall_hours between 0 and 24',
        'from daily_enriched where not (snowfall_hours between 0 and 24)',
    ),
    (
        'daily_enriched',
        'column_expression rain_sum is null or rain_sum >= 0',
        'from daily_enriched where not (rain_sum is null or rain_sum >= 0)',
    ),
    (
        'daily_enriched',
        'column_expression precipitation_sum is null or precipitation_sum >= 0',
        'from daily_enriched where not (precipitation_sum is null or precipitation_sum >= 0)',
    ),
    (
        'daily_enriched',
        'column_expression snowfall_sum is null or snowfall_sum >= 0',
        'from daily_enriched where not (snowfall_sum is null or snowfall_sum >= 0)',
    ),
    (
        'daily_enriched',
        'column_expression sunshine_duration is null or sunshine_duration between 0 and 86400',
        'from daily_enriched where not (sunshine_duration is null or sunshine_duration between 0 and 86400)',
    ),
    (
        'daily_enriched',
        'column_expression diff_temp_max_api_vs_hourly is null or abs(diff_temp_max_api_vs_hourly) <= 8',
        'from daily_enriched where not (diff_temp_max_api_vs_hourly is null or abs(diff_temp_max_api_vs_hourly) <= 8)',
    ),
    (
        'daily_enriched',
        'column_expression diff_temp_min_api_vs_hourly is null or abs(diff_temp_min_api_vs_hourly) <= 8',
        'from daily_enriched where not (diff_temp_min_api_vs_hourly is null or abs(diff_temp_min_api_vs_hourly) <= 8)',
    ),
    (
        'daily_enriched',
        'column_expression diff_precip_api_vs_hourly is null or abs(diff_precip_api_vs_hourly) <= 20',
        'from daily_enriched where not (diff_precip_api_vs_hourly is null or abs(diff_precip_api_vs_hourly) <= 20)',
    ),
    (
        'fct_daily_api',
        'column_expression temperature_2m_max between -80 and 70',
        'from fct_daily_api where not (temperature_2m_max between -80 and 70)',
    ),
    (
        'fct_daily_api',
        'column_expression temperature_2m_min between -80 and 70',
        'from fct_daily_api where not (temperature_2m_min between -80 and 70)',
    ),
    (
        'fct_daily_api',
        'column_expression temperature_2m_mean between -80 and 70',
        'from fct_daily_api where not (temperature_2m_mean between -80 and 70)',
    ),
    (
        'fct_daily_api',
        'column_expression rain_sum >= 0',
        'from fct_daily_api where not (rain_sum >= 0)',
    ),
    (
        'fct_daily_api',
        'column_expression precipitation_sum >= 0',
        'from fct_daily_api where not (precipitation_sum >= 0)',
    ),
    (
        'fct_daily_api',
        'column_expression snowfall_sum >= 0',
        'from fct_daily_api where not (snowfall_sum >= 0)',
    ),
    (
        'fct_daily_api',
        'column_expression sunshine_duration between 0 and 86400',
        'from fct_daily_api where not (sunshine_duration between 0 and 86400)',
    ),
    (
        'fct_daily_hourly',
        'column_expression temperature_2m_max between -80 and 60',
        'from fct_daily_hourly where not (temperature_2m_max between -80 and 60)',
    ),
    (
        'fct_daily_hourly',
        'column_expression temperature_2m_min between -80 and 60',
        'from fct_daily_hourly where not (temperature_2m_min between -80 and 60)',
    ),
    (
        'fct_daily_hourly',
        'column_expression temperature_2m_mean between -80 and 60',
        'from fct_daily_hourly where not (temperature_2m_mean between -80 and 60)',
    ),
    (
        'fct_daily_hourly',
        'column_expression rain_sum >= 0',
        'from fct_daily_hourly where not (rain_sum >= 0)',
    ),
    (
        'fct_daily_hourly',
        'column_expression precipitation_sum >= 0',
        'from fct_daily_hourly where not (precipitation_sum >= 0)',
    ),
    (
        'fct_daily_hourly',
        'column_expression snowfall_sum >= 0',
        'from fct_daily_hourly where not (snowfall_sum >= 0)',
    ),
    (
        'fct_daily_hourly',
        'column_expression wind_speed_10m_max >= 0',
        'from fct_daily_hourly where not (wind_speed_10m_max >= 0)',
    ),
    (
        'fct_daily_hourly',
        'column_expression wind_speed_10m_mean >= 0',
        'from fct_daily_hourly where not (wind_speed_10m_mean >= 0)',
    ),
    (
        'fct_daily_hourly',
        'column_expression precip_hours between 0 and 24',
        'from fct_daily_hourly where not (precip_hours between 0 and 24)',
    ),
    (
        'fct_daily_hourly',
        'column_expression rain_hours between 0 and 24',
        'from fct_daily_hourly where not (rain_hours between 0 and 24)',
    ),
    (
        'fct_daily_hourly',
        'column_expression snowfall_hours between 0 and 24',
        'from fct_daily_hourly where not (snowfall_hours between 0 and 24)',
    ),
    (
        'fct_daily',
        'column_expression temperature_2m_max between -80 and 70',
        'from fct_daily where not (temperature_2m_max between -80 and 70)',
    ),
    (
        'fct_daily',
        'column_expression temperature_2m_min between -80 and 70',
        'from fct_daily where not (temperature_2m_min between -80 and 70)',
    ),
    (
        'fct_daily',
        'column_expression temperature_2m_mean between -80 and 70',
        'from fct_daily where not (temperature_2m_mean between -80 and 70)',
    ),
    (
        'fct_daily',
        'column_expression rain_sum >= 0',
        'from fct_daily where not (rain_sum >= 0)',
    ),
    (
        'fct_daily',
        'column_expression precipitation_sum >= 0',
        'from fct_daily where not (precipitation_sum >= 0)',
    ),
    (
        'fct_daily',
        'column_expression snowfall_sum >= 0',
        'from fct_daily where not (snowfall_sum >= 0)',
    ),
    (
        'fct_daily',
        'column_expression sunshine_duration between 0 and 86400',
        'from fct_daily where not (sunshine_duration between 0 and 86400)',
    ),
    (
        'fct_daily',
        'column_expression precip_hours between 0 and 24',
        'from fct_daily where not (precip_hours between 0 and 24)',
    ),
    (
        'fct_daily',
        'column_expression rain_hours between 0 and 24',
        'from fct_daily where not (rain_hours between 0 and 24)',
    ),
    (
        'fct_daily',
        'column_expression snowfall_hours between 0 and 24',
        'from fct_daily where not (snowfall_hours between 0 and 24)',
    ),
    (
        'fct_daily_quality',
        'column_expression completeness_score between 0 and 1',
        'from fct_daily_quality where not (completeness_score between 0 and 1)',
    ),
)
