"""Numbers, labels and patterns that results depend on."""

# ---- units -------------------------------------------------------------
MS_TO_MPH = 2.2369362920544
M_TO_YARDS = 1.0936132983377
MPH_TO_MS = 0.44704
YARDS_PER_METRE = 1.0 / 0.9144
METRES_PER_DEGREE = 111320.0
FEET_PER_YARD = 3.0

# ---- sources -----------------------------------------------------------
SOURCES = ["trackman", "foresight", "caddieset", "flightscope", "manual"]
OPEN_END = "9999-12-31"
UNKNOWN_PLAYER = "unknown|1900-01-01"
UNKNOWN_CLUB = "unknown|unknown|1900-01-01"

MEASURES = [
    "ball_speed_mph", "club_speed_mph", "smash_factor", "launch_angle_deg",
    "spin_rate_rpm", "carry_yards", "total_yards", "side_dispersion",
    "spin_axis_deg", "launch_direction_deg",
]
COMMON_COLUMNS = ["shot_id", "source", "player", "club", "session_date", *MEASURES]
SESSION_COLUMNS = ["player", "club", "session_date", *MEASURES]
# Fields a column-mapping proposal may target (shape columns are not among them).
MAPPABLE_FIELDS = [
    "player", "club", "session_date", "ball_speed_mph", "club_speed_mph",
    "smash_factor", "launch_angle_deg", "spin_rate_rpm", "carry_yards",
    "total_yards", "side_dispersion",
]

# ---- club codes --------------------------------------------------------
CAMERA_CLUBS = {
    "W1": "Driver", "W3": "3 Wood", "I4": "4 Iron", "I5": "5 Iron",
    "I6": "6 Iron", "I7": "7 Iron", "I8": "8 Iron", "I9": "9 Iron",
}
DOPPLER_CLUBS = {
    "Driver": "Driver", "PW": "Pitching Wedge", "GW": "Gap Wedge",
    "SW": "Sand Wedge", "LW": "Lob Wedge",
}
BAG_LABELS = {
    "dr": "Driver", "d": "Driver", "3w": "3-wood", "5w": "5-wood",
    "7w": "7-wood", "hy": "Hybrid", "hybrid": "Hybrid", "pw": "PW",
    "pitching wedge": "PW",
}

# Export headers (lower case, letters and digits only) per common field.
HEADER_ALIASES = {
    "shot_id": ["shotid"],
    "source": ["source"],
    "player": ["player", "name", "playername"],
    "club": ["club", "clubtype", "clubname"],
    "session_date": ["sessiondate", "date"],
    "ball_speed_mph": ["ballspeedmph", "ballspeed"],
    "club_speed_mph": ["clubspeedmph", "clubspeed", "clubheadspeed"],
    "smash_factor": ["smashfactor", "smash"],
    "launch_angle_deg": [
        "launchangledeg", "launchangle", "launchv", "verticallaunchangle",
        "launchanglevertical", "vla",
    ],
    "spin_rate_rpm": ["spinraterpm", "spinrate", "spin", "totalspin", "backspin"],
    "carry_yards": ["carryyards", "carry", "carrydistance", "carrydist"],
    "total_yards": ["totalyards", "total", "totaldistance", "totaldist"],
    "side_dispersion": [
        "sidedispersion", "side", "sidecarry", "carryside", "lateral",
        "sidetotal", "offline",
    ],
    "spin_axis_deg": ["spinaxisdeg", "spinaxis", "axis"],
    "launch_direction_deg": [
        "launchdirectiondeg", "launchdirection", "launchh",
        "horizontallaunchangle", "hla", "azimuth", "launchdir",
    ],
}

# ---- sampling and trimming ---------------------------------------------
MIN_SHOTS = 8
TRIM_LOW, TRIM_HIGH = 0.05, 0.95
MEDIAN_BAND = (0.7, 1.3)
MAX_CLUBS = 6
BENCHMARK_SIGMA = 5.0
ROLL_COEFF = 0.091
ROLL_SPIN_DECAY = 0.00155

# ---- standard atmosphere -----------------------------------------------
GAS_CONSTANT = 287.05
LAPSE_RATE = 0.0065
SEA_LEVEL_K = 288.15
SEA_LEVEL_PA = 101325.0
GRAVITY = 9.80665

# ---- expected strokes to hole out --------------------------------------
# Published tour averages: yards and strokes per lie, then feet and putts.
CURVE_YARDS = [5, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100, 120, 140, 160, 180, 200, 220, 240]
CURVE_STROKES = {
    "fairway": [2.05, 2.18, 2.40, 2.52, 2.58, 2.63, 2.67, 2.70, 2.72, 2.75, 2.80,
                2.85, 2.91, 2.98, 3.08, 3.19, 3.30, 3.40],
    "rough": [2.15, 2.34, 2.59, 2.70, 2.78, 2.85, 2.88, 2.91, 2.93, 2.97, 3.02,
              3.08, 3.15, 3.23, 3.31, 3.39, 3.48, 3.57],
    "sand": [2.37, 2.45, 2.53, 2.66, 2.82, 2.92, 2.99, 3.03, 3.06, 3.09, 3.10,
             3.14, 3.19, 3.23, 3.29, 3.36, 3.43, 3.51],
    "recovery": [3.30, 3.35, 3.45, 3.52, 3.58, 3.63, 3.68, 3.72, 3.76, 3.78, 3.80,
                 3.82, 3.84, 3.87, 3.91, 3.97, 4.04, 4.11],
}
PUTT_FEET = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 15, 20, 25, 30, 40, 50, 60, 90]
PUTT_STROKES = [1.001, 1.01, 1.04, 1.13, 1.23, 1.34, 1.42, 1.50, 1.56, 1.61, 1.78,
                1.87, 1.93, 1.98, 2.06, 2.14, 2.21, 2.40]
TEE_INTERCEPT, TEE_SLOPE = 2.38, 0.0041
PUTT_SKILL_WEIGHT = 0.6
GREEN_TAX_BASE, GREEN_TAX_SKILL = 0.18, 0.55
GREEN_ZONE_YARDS = 30.0
PUTT_RADIUS_YARDS = 5.0

# ---- strategy ----------------------------------------------------------
DROP_BACK_YARDS = 30.0
SLOPE_PUTT = 0.35
WATER_STROKES = 3.7
PIN_INSETS = [4.0, 2.0, 0.0]
PIN_GRADE_QUANTILE = 0.7
LOST_STROKES = 8.0
UNREACHABLE_STROKES = 50.0
ELEVATION_CARRY = 0.93
AIM_SHORT, AIM_LONG, AIM_STEPS = 30.0, 12.0, 8
AIM_LATERALS = [-130.0, -85.0, -52.0, -28.0, -12.0, 0.0, 12.0, 28.0, 52.0, 85.0, 130.0]
# lie -> (carry multiplier, spread multiplier); every other lie plays clean.
LIE_PLAY = {"clean": (1.0, 1.0), "rough": (0.90, 1.6), "sand": (0.70, 2.3), "recovery": (0.45, 2.8)}
SHAPE_SKEW = {"draw": -0.35, "straight": 0.0, "fade": 0.35}
SHORT_GAME = {"Tour": 0.0, "Sharp": 0.12, "Average": 0.25, "Loose": 0.40}
# profile -> (tour table, distance scale)
PROFILES = {
    "PGA tour pro": ("pga", 1.00), "Long amateur": ("pga", 0.92),
    "Mid handicap": ("pga", 0.83), "Senior": ("pga", 0.74), "LPGA tour": ("lpga", 1.00),
}

# Published tour averages per club: club speed, attack angle, ball speed, smash,
# launch angle, spin rate, max height, land angle, carry.
TOUR_COLUMNS = [
    "club_speed_mph", "attack_angle_deg", "ball_speed_mph", "smash_factor",
    "launch_angle_deg", "spin_rate_rpm", "max_height_yards", "land_angle_deg", "carry_yards",
]
TOUR_AVERAGES = {
    "pga": {
        "Driver": (115, -0.9, 171, 1.49, 10.4, 2545, 35, 39, 282),
        "3-wood": (110, -2.3, 162, 1.47, 9.3, 3663, 32, 44, 249),
        "5-wood": (106, -2.5, 156, 1.47, 9.7, 4322, 33, 48, 236),
        "Hybrid": (102, -2.4, 149, 1.47, 10.2, 4587, 31, 49, 231),
        "3-iron": (100, -2.5, 145, 1.46, 10.3, 4404, 30, 48, 218),
        "4-iron": (98, -2.9, 140, 1.44, 10.9, 4762, 31, 49, 209),
        "5-iron": (96, -3.4, 135, 1.41, 11.9, 5280, 33, 50, 199),
        "6-iron": (94, -3.7, 130, 1.39, 14.0, 6204, 32, 50, 188),
        "7-iron": (92, -3.9, 123, 1.34, 16.1, 7124, 34, 51, 176),
        "8-iron": (89, -4.2, 118, 1.33, 17.8, 8078, 33, 51, 164),
        "9-iron": (87, -4.3, 112, 1.29, 20.0, 8793, 32, 52, 152),
        "PW": (84, -4.7, 104, 1.24, 23.7, 9316, 32, 52, 142),
    },
    "lpga": {
        "Driver": (96, 2.8, 143, 1.49, 12.6, 2506, 26, 36, 223),
        "3-wood": (92, -0.8, 135, 1.47, 11.6, 3595, 25, 38, 200),
        "5-wood": (90, -1.6, 130, 1.46, 12.3, 4320, 25, 43, 189),
        "Hybrid": (87, -1.9, 125, 1.44, 13.9, 4504, 25, 45, 178),
        "4-iron": (82, -1.7, 118, 1.43, 13.9, 4608, 25, 44, 175),
        "5-iron": (81, -2.0, 114, 1.42, 14.6, 4966, 25, 45, 166),
        "6-iron": (80, -2.3, 111, 1.41, 16.7, 5904, 26, 46, 155),
        "7-iron": (78, -2.5, 106, 1.38, 18.5, 6630, 26, 47, 143),
        "8-iron": (76, -2.8, 102, 1.36, 20.8, 7413, 27, 47, 133),
        "9-iron": (74, -3.2, 95, 1.30, 23.5, 7605, 27, 48, 123),
        "PW": (72, -3.2, 88, 1.25, 25.2, 8465, 27, 48, 111),
    },
}
# source -> session id, date, place, device, carry method, ball.
SESSION_MANIFEST = {
    "trackman": ("trackman-001", "2024-07-15", "outdoor", "TrackMan", "measured", "premium"),
    "foresight": ("foresight-001", "2026-05-04", "outdoor", "Garmin R10", "estimated", "range"),
    "caddieset": ("caddieset-001", "2025-03-10", "indoor", "CaddieSet Camera", "estimated", "premium"),
    "flightscope": ("flightscope-001", "2019-01-01", "outdoor", "FlightScope Mevo", "estimated", "premium"),
    "manual": ("manual-001", "2026-05-10", "outdoor", "Personal launch monitor", "measured", "premium"),
}
