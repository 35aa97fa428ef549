"""Code tables and labels that results depend on."""

# FIPS state code -> (abbreviation, name)
STATES = {
    "01": ("AL", "Alabama"),
    "02": ("AK", "Alaska"),
    "04": ("AZ", "Arizona"),
    "05": ("AR", "Arkansas"),
    "06": ("CA", "California"),
    "08": ("CO", "Colorado"),
    "09": ("CT", "Connecticut"),
    "10": ("DE", "Delaware"),
    "11": ("DC", "District of Columbia"),
    "12": ("FL", "Florida"),
    "13": ("GA", "Georgia"),
    "15": ("HI", "Hawaii"),
    "16": ("ID", "Idaho"),
    "17": ("IL", "Illinois"),
    "18": ("IN", "Indiana"),
    "19": ("IA", "Iowa"),
    "20": ("KS", "Kansas"),
    "21": ("KY", "Kentucky"),
    "22": ("LA", "Louisiana"),
    "23": ("ME", "Maine"),
    "24": ("MD", "Maryland"),
    "25": ("MA", "Massachusetts"),
    "26": ("MI", "Michigan"),
    "27": ("MN", "Minnesota"),
    "28": ("MS", "Mississippi"),
    "29": ("MO", "Missouri"),
    "30": ("MT", "Montana"),
    "31": ("NE", "Nebraska"),
    "32": ("NV", "Nevada"),
    "33": ("NH", "New Hampshire"),
    "34": ("NJ", "New Jersey"),
    "35": ("NM", "New Mexico"),
    "36": ("NY", "New York"),
    "37": ("NC", "North Carolina"),
    "38": ("ND", "North Dakota"),
    "39": ("OH", "Ohio"),
    "40": ("OK", "Oklahoma"),
    "41": ("OR", "Oregon"),
    "42": ("PA", "Pennsylvania"),
    "44": ("RI", "Rhode Island"),
    "45": ("SC", "South Carolina"),
    "46": ("SD", "South Dakota"),
    "47": ("TN", "Tennessee"),
    "48": ("TX", "Texas"),
    "49": ("UT", "Utah"),
    "50": ("VT", "Vermont"),
    "51": ("VA", "Virginia"),
    "53": ("WA", "Washington"),
    "54": ("WV", "West Virginia"),
    "55": ("WI", "Wisconsin"),
    "56": ("WY", "Wyoming"),
    "72": ("PR", "Puerto Rico"),
}

FIPS_TO_ABBR = {fips: abbr for fips, (abbr, _) in STATES.items()}
ABBR_TO_FIPS = {abbr: fips for fips, (abbr, _) in STATES.items()}
ABBR_TO_NAME = dict(STATES.values())

# census table code -> column name
CENSUS_COLUMNS = {
    "B01003_001E": "total_pop",
    "B19001_016E": "hhi_150k_200k",
    "B19001_017E": "hhi_220k_plus",
    "B01001_005E": "males_10_14",
    "B01001_029E": "females_10_14",
    "B01001A_005E": "white_males_10_14",
    "B01001B_005E": "black_males_10_14",
    "B01001I_005E": "hispanic_males_10_14",
    "B01001A_020E": "white_females_10_14",
    "B01001B_020E": "black_females_10_14",
    "B01001I_020E": "hispanic_females_10_14",
}

# lower edges of the proficiency bands in the bracket table, and their column names
BRACKET_EDGES = [25, 50, 75]
BRACKET_BANDS = ["lt25", "b2550", "b5075", "gte75"]

# lower edges of the map's colour steps and the legend text
MAP_EDGES = [25, 35, 45, 55, 65]
MAP_LABELS = ["< 25%", "25–35%", "35–45%", "45–55%", "55–65%", "≥ 65%"]
MAP_NO_DATA = "No data"

# box shown when a state has no features: lon/lat min, lon/lat max
FALLBACK_BOX = (-125.0, 24.0, -66.0, 50.0)

# column names the expanded JSON tables keep for themselves
RESERVED_NAMES = ("year", "fetched_at", "id")
