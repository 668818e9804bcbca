"""Visual encodings of one reading.

Every function is a Column expression over the row at hand, so a table of any size is encoded in
its scan stage without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.numbers import as_column, exact_text, normalize, round_exact, truncate, zero_free


# ---------------------------------------------------------------- helpers
def lookup(key, table: dict, default=None) -> Column:
    """Code to label, missing code to ``default``."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(entries, as_column(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def _bands(value: Column, bands, last: Column, make, closed: bool) -> Column:
    """First band whose upper bound holds the value (``<=`` when closed, else ``<``)."""
    result = None
    for band in bands:
        inside = value <= F.lit(band[0]) if closed else value < F.lit(band[0])
        result = F.when(inside, make(band)) if result is None else result.when(inside, make(band))
    return result.otherwise(last)


def _linear(coefficients, value: Column) -> Column:
    base, slope = coefficients
    return F.lit(base) + value * F.lit(slope)


def _hsl(h, s, l) -> Column:
    columns = [x if isinstance(x, Column) else F.lit(float(x)) for x in (h, s, l)]
    return F.struct(*[c.cast("double").alias(n) for c, n in zip(columns, ("h", "s", "l"))])


# ---------------------------------------------------------------- reading to parameters
def base_color(norm) -> Column:
    """Piecewise linear colour, each channel truncated to int.

    Pass a column, not a long expression: it is read once per channel and segment.
    """
    norm = as_column(norm)

    def segment(i):
        within = (norm - F.lit(i * 0.25)) / F.lit(0.25)
        pairs = zip(K.RAMP[i], K.RAMP[i + 1])
        return F.array(*[truncate(F.lit(float(a)) + F.lit(float(b - a)) * within) for a, b in pairs])

    return (
        F.when(norm < 0.25, segment(0)).when(norm < 0.5, segment(1))
        .when(norm < 0.75, segment(2)).when(norm.isNotNull(), segment(3))
    )


def wind_vector(degrees) -> tuple[Column, Column]:
    """Unit vector of the wind bearing."""
    angle = F.radians(as_column(degrees).cast("double"))
    return zero_free(F.sin(angle)), zero_free(-F.cos(angle))


def compass(degrees) -> Column:
    """Sixteen-point label; the sector index is truncated, then wrapped."""
    sector = truncate((as_column(degrees).cast("double") + F.lit(11.25)) / F.lit(22.5))
    return F.element_at(F.array(*[F.lit(p) for p in K.COMPASS]), F.pmod(sector, F.lit(16)) + 1)


def weather_group(code) -> Column:
    """Family of a weather code."""
    code = as_column(code)
    (low, high, name), *rest = K.WEATHER_GROUPS
    result = F.when((code >= low) & (code < high), name)
    for low, high, name in rest:
        result = result.when((code >= low) & (code < high), name)
    return result.when(code == 800, "clear").when(code > 800, "clouds").otherwise("unknown")


def norms(prefix: str = "") -> dict[str, Column]:
    """P11 for every measured variable of a reading."""
    return {f"{prefix}{name}_norm": normalize(name, low, high) for name, (low, high) in K.RANGES.items()}


def visual_columns(prefix: str = "") -> dict[str, Column]:
    """All encoding parameters, from the columns of ``norms``."""
    dx, dy = wind_vector("wind_deg")
    pressure, pm, wet, wind, cloud, warm, rain = (
        F.col(f"{prefix}{v}_norm")
        for v in ("pressure", "pm2_5", "humidity", "wind_speed", "clouds", "temperature", "rain_1h"))
    return {
        "base_color": base_color(warm),
        "density": _linear(K.DENSITY, pressure),
        "num_layers": truncate(_linear(K.LAYERS, pressure)),
        "fragmentation": pm,
        "fragment_count": truncate(_linear(K.FRAGMENTS, pm)),
        "opacity_base": truncate(_linear(K.OPACITY, F.lit(1.0) - wet)),
        "veil_opacity": truncate(wet * F.lit(K.VEIL)),
        "wind_dx": dx,
        "wind_dy": dy,
        "wind_energy": wind,
        "stroke_length": truncate(_linear(K.STROKE_LENGTH, wind)),
        "stroke_width": F.greatest(F.lit(1), truncate(wind * F.lit(K.STROKE_WIDTH))),
        "bg_darkness": truncate(_linear(K.DARKNESS, cloud)),
        "temperature_norm": warm,
        "rain_norm": round_exact(rain, 3),
        "is_raining": F.col("rain_1h") > 0.0,
        "weather_group": weather_group("weather_id"),
    }


# ---------------------------------------------------------------- dominance
def dominance_scores(rounded: bool = False) -> list[Column]:
    """The six scores in tie-break order; ``rounded`` uses the three-decimal display values."""
    scores = [
        F.col("temperature_norm"),
        F.col("wind_energy"),
        F.col("veil_opacity") / F.lit(K.VEIL),
        F.col("density"),
        F.col("clouds") / F.lit(100.0),
        F.col("fragmentation"),
    ]
    return [round_exact(s, 3) for s in scores] if rounded else scores


def score_map(rounded: bool = False) -> Column:
    """Variable name to score."""
    pairs = zip(K.VARIABLES, dominance_scores(rounded))
    return F.create_map(*[x for name, score in pairs for x in (F.lit(name), score)])


def ranked_scores(rounded: bool = False) -> Column:
    """Variables ordered by score, ties in the fixed variable order (K4)."""
    entries = [
        F.struct((F.lit(0.0) - score).alias("below"), F.lit(i).alias("place"), F.lit(name).alias("name"))
        for i, (name, score) in enumerate(zip(K.VARIABLES, dominance_scores(rounded)))
    ]
    return F.sort_array(F.array(*entries))


def codominant(dominant, second) -> Column:
    """K5: a second variable is named only when pressure dominates."""
    return F.when(as_column(dominant) == "presion", as_column(second))


def codominant_boost(strength) -> Column:
    """K5: display strength of the co-dominant variable."""
    return F.least(F.lit(1.0), as_column(strength) * F.lit(K.CODOMINANT_BOOST))


# ---------------------------------------------------------------- colours
def temperature_hsl(temp_c) -> Column:
    """X12."""
    return _bands(as_column(temp_c), K.TEMPERATURE_BANDS, _hsl(*K.TEMPERATURE_BAND_LAST),
                  lambda b: _hsl(*b[1:]), closed=True)


def hour_hsl(hour) -> Column:
    """Background colour of the hour."""
    return _bands(as_column(hour), K.HOUR_BANDS, _hsl(*K.HOUR_BAND_LAST), lambda b: _hsl(*b[1:]), closed=False)


def light_position(hour, dominant=None, dx=None, dy=None) -> Column:
    """Light source as fractions of width and height; wind dominance points it downwind."""

    def point(x, y):
        return F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))

    by_hour = _bands(as_column(hour), K.LIGHT_BANDS, point(*K.LIGHT_BAND_LAST),
                     lambda b: point(*b[1:]), closed=False)
    if dominant is None:
        return by_hour
    angle = F.atan2(as_column(dy), as_column(dx))
    downwind = F.struct(
        (F.lit(0.5) + F.cos(angle) * K.WIND_LIGHT_REACH).alias("x"),
        (F.lit(0.5) + F.sin(angle) * K.WIND_LIGHT_REACH).alias("y"))
    return F.when(as_column(dominant) == "viento", downwind).otherwise(by_hour)


def dominant_tint(dominant) -> Column:
    table = F.create_map(*[x for name, hsl in K.DOMINANT_TINTS.items() for x in (F.lit(name), _hsl(*hsl))])
    return F.element_at(table, as_column(dominant))


def palette(hour, dominant, strength) -> Column:
    """Hour colour mixed with the tint of the dominant variable."""
    ground, tint = hour_hsl(hour), dominant_tint(dominant)
    mix = as_column(strength) * F.lit(K.TINT_MIX)
    keep = F.lit(1.0) - mix
    return F.struct(
        (ground["h"] * keep + tint["h"] * mix).alias("h"),
        (ground["s"] * keep + tint["s"] * mix * F.lit(K.TINT_SATURATION)).alias("s"),
        (ground["l"] * keep + tint["l"] * mix * F.lit(K.TINT_LIGHTNESS)).alias("l"),
    )


def variable_colour(variable: str, norm) -> Column:
    """Hue, saturation and lightness that follow a normalised value."""
    hue, s0, s1, l0, l1 = K.VARIABLE_COLOURS[variable]
    norm = as_column(norm)
    return _hsl(hue, F.lit(float(s0)) + norm * float(s1), F.lit(float(l0)) - norm * float(l1))


def wind_colour(energy, background_l) -> Column:
    """Wind strokes are darker on a light ground and lighter on a dark one."""
    energy, light = as_column(energy), as_column(background_l) > K.WIND_GROUND_LIGHT
    (dark_base, dark_slope, dark_floor), dark_saturation = K.WIND_ON_LIGHT
    (pale_base, pale_slope, pale_ceiling), pale_saturation = K.WIND_ON_DARK
    darker = F.greatest(F.lit(dark_floor), _linear((dark_base, -dark_slope), energy))
    paler = F.least(F.lit(pale_ceiling), _linear((pale_base, -pale_slope), energy))
    return _hsl(
        K.WIND_HUE,
        F.when(light, _linear(dark_saturation, energy)).otherwise(_linear(pale_saturation, energy)),
        F.when(light, darker).otherwise(paler),
    )


def modifiers(dominant, strength, dx, dy) -> Column:
    """Global drawing modifiers."""
    dominant, strength = as_column(dominant), as_column(strength)

    def only(name, value, other):
        return F.when(dominant == name, value).otherwise(F.lit(other))

    return F.struct(
        only("viento", F.atan2(as_column(dy), as_column(dx)) * K.WIND_ANGLE, 0.0).alias("angle"),
        F.when(dominant == "temperatura", _linear(K.TEMPERATURE_SCALE, strength))
        .when(dominant == "viento", _linear(K.WIND_SCALE, strength)).otherwise(F.lit(1.0)).alias("scale"),
        only("humedad", strength * K.HUMIDITY_BLUR, 0.0).alias("blur"),
        only("pm25", strength, 0.0).alias("noise"),
        only("nubes", F.lit(1.0) - strength * K.CLOUD_SQUISH, 1.0).alias("squish"),
        only("presion", strength, 0.0).alias("rigid"),
    )


def layer_order(dominant, second) -> Column:
    """Base order; the co-dominant layer goes before the last one, the dominant layer last."""
    dominant, second = as_column(dominant), as_column(second)
    base = F.array(*[F.lit(v) for v in K.DRAW_ORDER])
    rest = F.array_remove(base, second)
    count = F.size(rest)
    with_second = F.when(
        second.isNotNull(),
        F.concat(F.slice(rest, F.lit(1), count - 1), F.array(second), F.slice(rest, count, F.lit(1))),
    ).otherwise(base)
    return F.concat(F.array_remove(with_second, dominant), F.array(dominant))


# ---------------------------------------------------------------- bands
def rain_band(rain, raining) -> Column:
    """Intensity code of the last hour's rain."""
    return _rain(rain, raining, 1, K.RAIN_BAND_NONE[0], K.RAIN_BAND_LAST[0])


def rain_symbol(rain, raining) -> Column:
    """Symbol of the intensity."""
    return _rain(rain, raining, 2, K.RAIN_BAND_NONE[1], K.RAIN_BAND_LAST[1])


def _rain(rain, raining, field, dry, heavy) -> Column:
    wet = _bands(as_column(rain), K.RAIN_BANDS, F.lit(heavy), lambda b: F.lit(b[field]), closed=False)
    return F.when(~as_column(raining), F.lit(dry)).otherwise(wet)


def risk_level(risk) -> Column:
    """X19."""
    return _bands(as_column(risk), K.RISK_LEVELS, F.lit(K.RISK_LEVEL_LAST), lambda b: F.lit(b[1]), closed=False)


def is_alarm(risk, ready) -> Column:
    """F8: a ready model that sees at least the alarm risk."""
    return as_column(ready) & (as_column(risk) >= F.lit(K.RISK_ALARM))


def alarm_layers(risk, ready) -> Column:
    """Names of the active alarm layers, in drawing threshold order."""
    risk = as_column(risk)
    alarm = is_alarm(risk, ready)
    layers = [F.when(alarm, F.lit("edge"))] + [
        F.when(alarm & (risk > F.lit(bound)), F.lit(name)) for name, bound in K.RISK_LAYERS
    ]
    return F.array_compact(F.array(*layers))


def risk_counts(risk) -> Column:
    """Edge marks, fractures and the depth of the edge band."""
    risk = as_column(risk)
    return F.struct(
        F.floor(risk * K.RISK_EDGES).alias("edges"), F.floor(risk * K.RISK_FRACTURES).alias("fractures"),
        (risk * K.RISK_DEPTH).alias("depth"),
    )


def event_hsl(event) -> Column:
    """X21."""
    table = F.create_map(*[x for name, hsl in K.EVENT_HSL.items() for x in (F.lit(name), _hsl(*hsl))])
    return F.coalesce(F.try_element_at(table, as_column(event)), _hsl(*K.EVENT_HSL_DEFAULT))


def _steps(value, bounds, codes) -> Column:
    """The code of the first bound above the value, else the last code."""
    result = F.lit(codes[-1])
    for bound, code in reversed(list(zip(bounds, codes))):
        result = F.when(as_column(value) < F.lit(bound), F.lit(code)).otherwise(result)
    return result


def behaviour_bands(dominant, second) -> dict[str, Column]:
    """Behaviour code of each variable, with dominant and co-dominant variants."""
    dominant, second = as_column(dominant), as_column(second)
    hum, wind, pres = F.col("veil_opacity") / F.lit(K.VEIL), F.col("wind_energy"), F.col("density")
    cloud, pm = F.col("clouds") / F.lit(100.0), F.col("fragmentation")

    def pick(name, leading, seconding, plain):
        chosen = F.when(dominant == name, leading)
        return (chosen.when(second == name, seconding) if seconding is not None else chosen).otherwise(plain)

    def over(value, bound, yes, no):
        return F.when(value > bound, yes).otherwise(no)

    led, followed = F.lit("dominant"), F.lit("codominant")
    return {
        "humidity_band": pick(
            "humedad", over(hum, K.HUMIDITY_HALO[0], "dominant_halo", "dominant"),
            over(hum, K.HUMIDITY_HALO[1], "codominant_halo", "codominant"),
            _steps(hum, K.HUMIDITY_BANDS, ("low", "medium", "high"))),
        "wind_band": pick(
            "viento", _steps(wind, K.WIND_BANDS_DOMINANT, ("dominant_short", "dominant_medium", "dominant_long")),
            followed, _steps(wind, K.WIND_BANDS, ("calm", "moderate", "strong"))),
        "pressure_band": pick(
            "presion", over(pres, K.PRESSURE_DOMINANT, "dominant_bands", "dominant_fragments"), None,
            _steps(pres, K.PRESSURE_BANDS, ("low", "normal", "high"))),
        "temperature_band": pick("temperatura", led, followed, F.lit("base")),
        "cloud_band": pick("nubes", led, followed, _steps(cloud, K.CLOUD_BANDS, ("few", "medium", "many"))),
        "pm_band": pick("pm25", led, followed, _steps(pm, K.PM_BANDS, ("clean", "moderate", "high"))),
    }


def humidity_shape(humidity_norm, dominant, second) -> Column:
    """Dry air that neither dominates nor co-dominates is drawn with triangles."""
    plain = (as_column(dominant) != "humedad") & (F.coalesce(as_column(second), F.lit("")) != "humedad")
    return F.when((as_column(humidity_norm) < K.HUMIDITY_BANDS[0]) & plain, "triangle").otherwise("oval")


# ---------------------------------------------------------------- text
def fixed_text(value, digits: int) -> Column:
    """Fixed-point text of a double, ties away from zero on the binary value, sign always kept."""
    return exact_text(value, digits, ties="up")


def display_line() -> Column:
    """One-line summary of a reading."""
    return F.concat(
        fixed_text("temperature", 1), F.lit("°C · "), F.col("pressure").cast("string"), F.lit(" hPa · "),
        fixed_text("wind_speed", 1), F.lit("m/s · PM"), fixed_text("pm2_5", 0),
        F.lit(" · HR"), F.col("humidity").cast("string"), F.lit("%"),
    )


def edition_line(city, date, hour) -> Column:
    """Date, hour and upper-case city."""
    return F.concat(
        F.date_format(as_column(date), "yyyy-MM-dd"), F.lit(" · "), as_column(hour).cast("string"),
        F.lit("h · "), F.upper(as_column(city)),
    )


def dominance_header(dominant, second) -> Column:
    """Heading that names the dominant and, if any, the co-dominant variable."""
    label = lookup(dominant, K.DOMINANT_LABELS)
    return F.when(as_column(second).isNotNull(), F.concat(label, F.lit(" + "), F.upper(as_column(second)))).otherwise(label)


def fill_template(text, values: dict[str, Column]) -> Column:
    """Replace each ``__KEY__`` of a text by its value."""
    return reduce(
        lambda filled, item: F.replace(filled, F.lit(f"__{item[0]}__"), item[1]), values.items(), as_column(text)
    )
