"""Fixed values the results depend on.

FIXED VALUES — these must equal the behaviour being reproduced (category
strings, rule thresholds, AQI breakpoints, advice texts, baselines,
severity order). They are listed plainly and in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Category domain, mildest first.
SAFE = "Safe Air Day"
MODERATE = "Moderate Risk Day"
HIGH = "High Respiratory Risk Day"
MASK = "Mask Recommended Day"
AVOID = "Avoid Outdoor Activity Day"
CATEGORIES = [SAFE, MODERATE, HIGH, MASK, AVOID]

# Probability column per category (forecast scoring output).
PROB_COLUMNS = {
    SAFE: "prob_safe",
    MODERATE: "prob_moderate",
    HIGH: "prob_high_resp",
    MASK: "prob_mask",
    AVOID: "prob_avoid",
}

# Severity used by the "worst category" measure: 1 is the worst, unknown 6.
SEVERITY = {SAFE: 5, MODERATE: 4, HIGH: 3, MASK: 2, AVOID: 1}
SEVERITY_UNKNOWN = 6

# US EPA PM2.5 breakpoints: (pm_lo, pm_hi, aqi_lo, aqi_hi). Values outside
# every band (the holes between bands, negatives, above 500.4) map to 500.
PM25_AQI_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
]
AQI_OUT_OF_SCALE = 500
FORECAST_AQI_WHEN_NO_PM25 = 90

# AQI display scale: (lo, hi, colour, name); a value in no band is grey.
AQI_SCALE = [
    (0, 50, "#2ecc71", "Good"),
    (51, 100, "#f1c40f", "Moderate"),
    (101, 150, "#e67e22", "Unhealthy for Sensitive"),
    (151, 200, "#e74c3c", "Unhealthy"),
    (201, 300, "#8e44ad", "Very Unhealthy"),
    (301, 500, "#7b241c", "Hazardous"),
]
AQI_NO_BAND_COLOUR = "#95a5a6"

# Dashboard recommendation per category.
RECOMMENDATIONS = {
    SAFE: "✅ Air quality is good. Safe for all outdoor activities including exercise.",
    MODERATE: "⚠️ Acceptable air quality. Sensitive groups should limit prolonged outdoor exertion.",
    HIGH: "🟠 Elevated respiratory risk. People with asthma or heart disease should stay indoors.",
    MASK: "😷 Wear a mask outdoors. Minimize time outside. Keep windows closed.",
    AVOID: "🚫 Hazardous conditions. Everyone should stay indoors with windows closed.",
}

# Forecast-card advice per category, with its default.
FORECAST_ADVICE = {
    SAFE: "Good air quality expected. Outdoor activity is safe.",
    MODERATE: "Air quality will be moderate. Sensitive groups should limit prolonged outdoor exertion.",
    HIGH: "Elevated pollution forecast. Reduce outdoor activity, especially in the morning.",
    MASK: "Poor air quality expected. Wear an N95 mask outdoors and keep windows closed.",
    AVOID: "Hazardous conditions forecast. Stay indoors and use air purification if available.",
}
FORECAST_ADVICE_DEFAULT = "Forecast data unavailable."
NO_FORECAST = "No forecast available"
NO_SAFE_DAY = "None in 3-day window"

# Category colours used by the dashboard.
CATEGORY_COLOURS = {
    SAFE: "#2ecc71",
    MODERATE: "#f1c40f",
    HIGH: "#e67e22",
    MASK: "#e74c3c",
    AVOID: "#8e44ad",
}

# Forecast NULL/absent-column baselines (the four run-scoped ones —
# temp_max, temp_min, humidity_max, wind_max — come from the run's own
# temperature/humidity/wind extremes, with these fallbacks when absent).
FORECAST_BASELINE = {
    "pm25": 35.0,
    "pm10": 55.0,
    "aqi": 90.0,
    "ozone": 60.0,
    "nitrogen_dioxide": 25.0,
    "sulphur_dioxide": 5.0,
    "temp_max": 35.0,
    "temp_min": 18.0,
    "humidity_min": 30.0,
    "humidity_max": 60.0,
    "wind_max": 20.0,
    "wind_gust_max": 25.0,
    "apparent_temp_max": 38.0,
    "precipitation": 0.0,
}

LIVE_SOURCE = "api_daily"
MODEL_VERSION = "v2.1"
GAP_CHUNK_DAYS = 30
KMH_PER_MS = 3.6
SAFE_SHARE_WARNING_PCT = 15.0
# ---------------------------------------------------------- end fixed values
