"""Explicit schemas of every source and sink."""

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_INT, _DOUBLE, _TEXT = T.IntegerType(), T.DoubleType(), T.StringType()

WEATHER = _struct(
    coord=_struct(lat=_DOUBLE, lon=_DOUBLE),
    weather=T.ArrayType(_struct(id=_INT, main=_TEXT, description=_TEXT)),
    main=_struct(temp=_DOUBLE, temp_min=_DOUBLE, temp_max=_DOUBLE, feels_like=_DOUBLE, humidity=_INT,
                 pressure=_INT, sea_level=_INT, grnd_level=_INT),
    wind=_struct(speed=_DOUBLE, deg=_INT, gust=_DOUBLE),
    clouds=_struct(all=_INT),
    visibility=_INT,
    rain=_struct(**{"1h": _DOUBLE, "3h": _DOUBLE}),
    snow=_struct(**{"1h": _DOUBLE}),
    sys=_struct(sunrise=T.LongType(), sunset=T.LongType()),
    name=_TEXT,
)

AIR = _struct(
    coord=_struct(lat=_DOUBLE, lon=_DOUBLE),
    list=T.ArrayType(_struct(
        main=_struct(aqi=_INT),
        components=_struct(pm2_5=_DOUBLE, pm10=_DOUBLE, no2=_DOUBLE, o3=_DOUBLE, co=_DOUBLE, so2=_DOUBLE, nh3=_DOUBLE),
    )),
)

# as landed: with the time of the reading in epoch seconds
LANDED_WEATHER = T.StructType([*WEATHER.fields, T.StructField("dt", T.LongType())])
LANDED_AIR = _struct(
    coord=AIR["coord"].dataType,
    list=T.ArrayType(T.StructType([*AIR["list"].dataType.elementType.fields, T.StructField("dt", T.LongType())])),
)

RAW_HISTORY = _struct(
    datetime=_TEXT, date=T.DateType(), hour=_INT, temperature=_DOUBLE, pressure=_INT, wind_speed=_DOUBLE,
    humidity=_INT, clouds=_INT, pm2_5=_DOUBLE, rain_1h=_DOUBLE,
)

DAILY_HISTORY = _struct(
    date=T.DateType(), n_readings=T.LongType(), temp_c_max=_DOUBLE, temp_c_min=_DOUBLE, temp_c_mean=_DOUBLE,
    pressure_hpa_mean=_DOUBLE, pressure_hpa_min=_INT, wind_speed_max=_DOUBLE, wind_speed_mean=_DOUBLE,
    humidity_max=_INT, humidity_mean=_DOUBLE, precip_mm_sum=_DOUBLE, cloud_cover_mean=_DOUBLE, pm2_5_mean=_DOUBLE,
)

GRID = _struct(
    valid_time=T.TimestampType(), latitude=_DOUBLE, longitude=_DOUBLE, t2m=_DOUBLE, sp=_DOUBLE, u10=_DOUBLE,
    v10=_DOUBLE, d2m=_DOUBLE, tp=_DOUBLE, tcc=_DOUBLE,
)

# fields recorded by the oldest to the newest payload; every one is optional
PAYLOAD = _struct(
    city=_TEXT, date=_TEXT, hour=_INT, temp_c=_DOUBLE, pressure=_INT, wind_speed=_DOUBLE, wind_dir=_TEXT,
    wind_dir_label=_TEXT, wind_dx=_DOUBLE, wind_dy=_DOUBLE, pm25=_DOUBLE, humidity=_INT, clouds=_INT,
    temp_norm=_DOUBLE, pressure_norm=_DOUBLE, wind_energy=_DOUBLE, pm_norm=_DOUBLE, humidity_norm=_DOUBLE,
    cloud_norm=_DOUBLE, rain_1h=_DOUBLE, rain_norm=_DOUBLE, is_raining=T.BooleanType(), weather_id=_INT,
    weather_group=_TEXT, day_type=_TEXT, dominant=_TEXT, dominant_strength=_DOUBLE, dominant2=_TEXT,
    dominant2_strength=_DOUBLE, risk_score=_DOUBLE, event_type=_TEXT, ml_ready=T.BooleanType(),
)

ARCHIVE = _struct(
    date=T.DateType(), hour=_INT, city=_TEXT, image_path=_TEXT, temp_c=_DOUBLE, pressure=_INT, wind_speed=_DOUBLE,
    wind_dir=_TEXT, humidity=_INT, clouds=_INT, pm25=_DOUBLE, temp_norm=_DOUBLE, pressure_norm=_DOUBLE,
    wind_energy=_DOUBLE, humidity_norm=_DOUBLE, cloud_norm=_DOUBLE, pm_norm=_DOUBLE, dominant=_TEXT,
    dominant_strength=_DOUBLE, dominant2=_TEXT, ml_ready=T.BooleanType(), risk_score=_DOUBLE, event_type=_TEXT,
)

METRICS = _struct(
    model=_TEXT, mean_f1=_DOUBLE, mean_auc=_DOUBLE,
    folds=T.ArrayType(_struct(fold=_INT, f1=_DOUBLE, auc=_DOUBLE)),
    top_features=T.ArrayType(_struct(feature=_TEXT, importance=_DOUBLE)),
    n_features=_INT, n_samples=T.LongType(), event_rate=_DOUBLE,
)
