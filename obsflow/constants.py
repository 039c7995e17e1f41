"""Fixed values. They decide results, so they are stated once, here, and used everywhere."""

# The raw weather classes that are merged into others, and what is left.
MERGED_CLASSES = {
    "Fog": ("Smoke", "Haze", "Mist"),
    "Rain": ("Drizzle", "Thunderstorm"),
}
FINAL_CLASSES = ("Clear", "Clouds", "Fog", "Rain", "Snow")

# Colour per class and temperature in degrees Celsius. Each pair is the upper
# limit (exclusive) and the colour below it; the last pair of a class has no limit.
COLOUR_BANDS = {
    "Clear": ((0.0, "#ffff00"), (10.0, "#ffee00"), (20.0, "#ffdd00"), (30.0, "#ffcc00"), (None, "#ffbb00")),
    "Clouds": ((0.0, "#d2d2d2"), (10.0, "#bababa"), (20.0, "#a5a5a5"), (25.0, "#939393"), (None, "#787878")),
    "Fog": ((0.0, "#efebe9"), (5.0, "#d7ccc8"), (10.0, "#bcaaa4"), (15.0, "#a1887f"), (None, "#8d6e63")),
    "Rain": ((5.0, "#76cfff"), (10.0, "#00bfff"), (15.0, "#00a8ff"), (25.0, "#0091ff"), (None, "#0079ff")),
    "Snow": ((-10.0, "#e0ffff"), (-5.0, "#c0ffff"), (0.0, "#80ffff"), (5.0, "#00ffff"), (None, "#4feeee")),
}
DEFAULT_COLOUR = "#ffffff"

# The stations of the historical backfill, as (name, latitude, longitude).
STATIONS = (
    ("Milano", 45.4642, 9.1895),
    ("Torino", 45.0704, 7.6868),
    ("Genova", 44.4264, 8.9151),
    ("Aosta", 45.7376, 7.3172),
    ("Trento", 46.0678, 11.1210),
    ("Trieste", 45.6432, 13.7903),
    ("Venezia", 45.4371, 12.3326),
    ("Bologna", 44.4938, 11.3387),
    ("Firenze", 43.7792, 11.2462),
    ("Perugia", 43.1122, 12.3887),
    ("Ancona", 43.5942, 13.5033),
    ("Roma", 41.8919, 12.5113),
    ("Aquila", 42.3505, 13.3995),
    ("Campobasso", 41.5594, 14.6673),
    ("Napoli", 40.8563, 14.2464),
    ("Bari", 41.1114, 16.8554),
    ("Potenza", 40.6417, 15.8079),
    ("Catanzaro", 38.8824, 16.6008),
    ("Palermo", 38.1320, 13.3356),
    ("Cagliari", 39.2305, 9.1191),
)

# The numeric features, in the order the models take them.
FEATURES = ("lon", "lat", "hour", "temp", "tempfelt", "pressure", "humidity")

# Operating constants.
KELVIN_OFFSET = 273.15
SECONDS_PER_DAY = 86400
SERVING_HOUR_OFFSET = 2  # added to the UTC hour of live observations, without wrapping
LABEL_SHIFT_ROWS = 3
IDS_PER_REQUEST = 20
POINT_LIFETIME_SECONDS = 90
BATCH_INTERVAL = "5 seconds"
BACKFILL_DAYS = 5
