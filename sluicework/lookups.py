"""Default domain tables.

Every operator takes its table as a parameter; these are the defaults. The values below are fixed values: results
depend on them exactly, so they are stated as plain text.
"""

from __future__ import annotations

# --- fixed values: province names and codes -------------------------------------------------------------------------
PROVINCE_NAMES: dict[str, str] = {
    "ab": "Alberta",
    "alberta": "Alberta",
    "bc": "British Columbia",
    "b.c.": "British Columbia",
    "british columbia": "British Columbia",
    "mb": "Manitoba",
    "manitoba": "Manitoba",
    "nb": "New Brunswick",
    "new brunswick": "New Brunswick",
    "nl": "Newfoundland and Labrador",
    "newfoundland": "Newfoundland and Labrador",
    "newfoundland and labrador": "Newfoundland and Labrador",
    "ns": "Nova Scotia",
    "nova scotia": "Nova Scotia",
    "nt": "Northwest Territories",
    "northwest territories": "Northwest Territories",
    "nu": "Nunavut",
    "nunavut": "Nunavut",
    "on": "Ontario",
    "ontario": "Ontario",
    "pe": "Prince Edward Island",
    "pei": "Prince Edward Island",
    "prince edward island": "Prince Edward Island",
    "qc": "Quebec",
    "quebec": "Quebec",
    "québec": "Quebec",
    "sk": "Saskatchewan",
    "saskatchewan": "Saskatchewan",
    "yt": "Yukon",
    "yukon": "Yukon",
}

PROVINCE_CODES: dict[str, str] = {
    "ON": "Ontario",
    "BC": "British Columbia",
    "AB": "Alberta",
    "QC": "Quebec",
    "MB": "Manitoba",
    "SK": "Saskatchewan",
    "NS": "Nova Scotia",
    "NB": "New Brunswick",
    "NL": "Newfoundland and Labrador",
    "PE": "Prince Edward Island",
    "NT": "Northwest Territories",
    "NU": "Nunavut",
    "YT": "Yukon",
}

# The full province domain, in report order.
PROVINCE_DOMAIN: list[str] = sorted(PROVINCE_CODES.values())

# --- fixed values: city aliases (None means "not a city") -----------------------------------------------------------
CITY_ALIASES: dict[str, str | None] = {
    "greater vancouver": "Vancouver",
    "north vancouver": "Vancouver",
    "downtown": None,
    "king and spadina": "Toronto",
    "hamilton region": "Hamilton",
    "waterloo region": "Waterloo",
    "winnipeg region": "Winnipeg",
    "fort mcmurray region": "Fort McMurray",
    "halifax regional municipality": "Halifax",
}

# --- fixed values: country names ------------------------------------------------------------------------------------
COUNTRY_NAMES: dict[str, str] = {"ca": "Canada", "canada": "Canada", "anywhere": "Anywhere"}
COUNTRY_DEFAULT = "Anywhere"

# --- fixed values: employment types ---------------------------------------------------------------------------------
EMPLOYMENT_TYPES: dict[str, str] = {
    "full-time": "Full-time",
    "fulltime": "Full-time",
    "full_time": "Full-time",
    "full": "Full-time",
    "ft": "Full-time",
    "part-time": "Part-time",
    "parttime": "Part-time",
    "part_time": "Part-time",
    "part": "Part-time",
    "pt": "Part-time",
    "contract": "Contract",
    "contractor": "Contract",
    "contract_to_hire": "Contract",
    "temporary": "Contract",
    "temp": "Contract",
    "internship": "Internship",
    "intern": "Internship",
    "permanent": "Full-time",
}

# --- fixed values: city -> province. The order matters: among names of equal length the earlier one wins a text scan.
CITY_PROVINCES: dict[str, str] = {
    "toronto": "Ontario",
    "vancouver": "British Columbia",
    "calgary": "Alberta",
    "edmonton": "Alberta",
    "montreal": "Quebec",
    "ottawa": "Ontario",
    "mississauga": "Ontario",
    "brampton": "Ontario",
    "markham": "Ontario",
    "hamilton": "Ontario",
    "london": "Ontario",
    "kitchener": "Ontario",
    "waterloo": "Ontario",
    "windsor": "Ontario",
    "richmond hill": "Ontario",
    "oakville": "Ontario",
    "burlington": "Ontario",
    "oshawa": "Ontario",
    "barrie": "Ontario",
    "kingston": "Ontario",
    "sudbury": "Ontario",
    "thunder bay": "Ontario",
    "vaughan": "Ontario",
    "surrey": "British Columbia",
    "burnaby": "British Columbia",
    "richmond": "British Columbia",
    "abbotsford": "British Columbia",
    "kelowna": "British Columbia",
    "kamloops": "British Columbia",
    "port moody": "British Columbia",
    "coquitlam": "British Columbia",
    "victoria": "British Columbia",
    "red deer": "Alberta",
    "lethbridge": "Alberta",
    "fort mcmurray": "Alberta",
    "medicine hat": "Alberta",
    "grande prairie": "Alberta",
    "quebec city": "Quebec",
    "laval": "Quebec",
    "gatineau": "Quebec",
    "longueuil": "Quebec",
    "sherbrooke": "Quebec",
    "saguenay": "Quebec",
    "levis": "Quebec",
    "trois-rivieres": "Quebec",
    "saint-hyacinthe": "Quebec",
    "drummondville": "Quebec",
    "winnipeg": "Manitoba",
    "brandon": "Manitoba",
    "saskatoon": "Saskatchewan",
    "regina": "Saskatchewan",
    "halifax": "Nova Scotia",
    "dartmouth": "Nova Scotia",
    "sydney": "Nova Scotia",
    "moncton": "New Brunswick",
    "saint john": "New Brunswick",
    "fredericton": "New Brunswick",
    "st. john's": "Newfoundland and Labrador",
    "whitehorse": "Yukon",
    "yellowknife": "Northwest Territories",
    "iqaluit": "Nunavut",
}

# Names whose written form is not plain title case.
CITY_SPELLINGS: dict[str, str] = {"fort mcmurray": "Fort McMurray", "st. john's": "St. John's"}


def city_display(key: str) -> str:
    """Written form of a lower-case city key."""
    return CITY_SPELLINGS.get(key, key.title())


# --- fixed values: city coordinates (latitude, longitude) -----------------------------------------------------------
CITY_COORDINATES: dict[str, tuple[float, float]] = {
    "Toronto": (43.6532, -79.3832),
    "Vancouver": (49.2827, -123.1207),
    "Montreal": (45.5017, -73.5673),
    "Calgary": (51.0447, -114.0719),
    "Edmonton": (53.5461, -113.4938),
    "Ottawa": (45.4215, -75.6972),
    "Winnipeg": (49.8951, -97.1384),
    "Quebec City": (46.8139, -71.2080),
    "Hamilton": (43.2557, -79.8711),
    "Kitchener": (43.4516, -80.4925),
    "Waterloo": (43.4668, -80.5164),
    "London": (43.0096, -81.2737),
    "Halifax": (44.6488, -63.5752),
    "Victoria": (48.4284, -123.3656),
    "Saskatoon": (52.1332, -106.6700),
    "Regina": (50.4452, -104.6189),
    "St. John's": (47.5615, -52.7126),
    "Moncton": (46.0878, -64.7782),
    "Fredericton": (45.9636, -66.6431),
    "Windsor": (42.3149, -83.0364),
    "Mississauga": (43.5890, -79.6441),
    "Brampton": (43.7315, -79.7624),
    "Markham": (43.8561, -79.3370),
    "Richmond Hill": (43.8828, -79.4403),
    "Guelph": (43.5448, -80.2482),
    "Barrie": (44.3894, -79.6903),
    "Kelowna": (49.8880, -119.4960),
    "Abbotsford": (49.0504, -122.3045),
    "Surrey": (49.1913, -122.8490),
    "Burnaby": (49.2488, -122.9805),
    "Oakville": (43.4675, -79.6877),
    "Burlington": (43.3255, -79.7990),
    "Oshawa": (43.8971, -78.8658),
    "Sherbrooke": (45.4042, -71.8929),
    "Laval": (45.6066, -73.7124),
    "Longueuil": (45.5315, -73.5180),
    "Gatineau": (45.4765, -75.7013),
    "Sudbury": (46.4917, -80.9930),
    "Thunder Bay": (48.3809, -89.2477),
    "Lethbridge": (49.6956, -112.8451),
    "Red Deer": (52.2690, -113.8116),
    "Kamloops": (50.6745, -120.3273),
    "Nanaimo": (49.1659, -123.9401),
}

# --- fixed values: seniority levels, title rules in priority order, years brackets ----------------------------------
SENIORITY_ORDER: list[str] = ["Intern", "Junior", "Mid", "Senior", "Lead", "Director+"]
SENIOR_LABELS: list[str] = ["Senior", "Lead", "Director+"]

TITLE_RULES: list[tuple[str, list[str]]] = [
    ("Intern", [r"\bintern\b", r"\binternship\b", r"\bco-op\b", r"\bcoop\b"]),
    (
        "Junior",
        [r"\bjunior\b", r"\bjr\b", r"\bentry[\s-]level\b", r"\bassociate\b", r"\bnew\s+grad\b", r"\bgraduate\b"],
    ),
    ("Senior", [r"\bsenior\b", r"\bsr\b"]),
    ("Lead", [r"\blead\b", r"\bstaff\b", r"\bprincipal\b", r"\barchitect\b"]),
    (
        "Director+",
        [r"\bdirector\b", r"\bhead\s+of\b", r"\bvp\b", r"\bvice\s+president\b", r"\bchief\b", r"\bmanager\b"],
    ),
]
YEARS_BRACKETS: list[tuple[int, str]] = [(2, "Junior"), (5, "Mid"), (9, "Senior"), (99, "Lead")]
SENIORITY_DEFAULT = "Mid"

# --- fixed values: patterns for years of experience, in priority order ----------------------------------------------
YEARS_PATTERNS: list[str] = [
    r"(\d+)\s*[-–to]+\s*\d+\s+years?\s+(?:of\s+)?(?:relevant\s+|work\s+)?experience",
    r"(\d+)\+?\s+years?\s+(?:of\s+)?(?:relevant\s+|work\s+)?experience",
    r"minimum\s+(?:of\s+)?(\d+)\s+years?",
    r"at\s+least\s+(\d+)\s+years?",
    r"(\d+)\+?\s+years?\s+(?:of\s+)?(?:industry\s+)?experience",
]
# A word in every ASCII text that the pattern matches.
YEARS_WORDS: list[str] = ["experience", "experience", "minimum", "least", "experience"]

# --- fixed values: pay ----------------------------------------------------------------------------------------------
HOURS_PER_YEAR = 2080
ANNUAL_CAP = 500_000
AMOUNT_PATTERN = r"(?:CA\$|C\$|\$|CAD\s*)?([\d,]+(?:\.\d+)?)\s*([Kk])?"
RANGE_PATTERN = r"\s*[–\-]\s*|\s+to\s+"

# --- fixed values: words that mark remote work ----------------------------------------------------------------------
REMOTE_WORDS: list[str] = ["remote", "work from home"]

# --- fixed values: id prefixes of the sources -----------------------------------------------------------------------
SOURCE_PREFIXES: list[str] = ["adzuna", "theirstack", "serpapi"]
SOURCE_DEFAULT = "jsearch"

# --- fixed values: the tag taxonomy, by category, with written forms ------------------------------------------------
TAG_CATEGORIES: dict[str, list[str]] = {
    "Languages": ["python", "sql", "r", "java", "scala", "julia", "sas", "matlab", "bash"],
    "Modeling": [
        "statistics", "machine learning", "deep learning", "generative ai", "llm", "nlp", "computer vision",
        "reinforcement learning", "time series", "a/b testing", "feature engineering", "transformers",
        "anomaly detection", "forecasting", "scikit-learn", "tensorflow", "pytorch", "keras", "xgboost", "lightgbm",
        "hugging face", "langchain", "mlflow",
    ],
    "Analytics": [
        "pandas", "numpy", "scipy", "matplotlib", "seaborn", "plotly", "dask", "tableau", "power bi", "looker",
        "excel", "qlik",
    ],
    "Infrastructure": [
        "aws", "azure", "gcp", "sagemaker", "databricks", "snowflake", "bigquery", "redshift", "postgresql", "mysql",
        "mongodb", "elasticsearch", "spark", "hadoop", "kafka", "airflow", "dbt", "luigi", "prefect", "dagster",
        "docker", "kubernetes", "kubeflow", "wandb", "fastapi", "flask", "git", "linux", "terraform",
    ],
}
TAXONOMY: list[str] = [tag for tags in TAG_CATEGORIES.values() for tag in tags]
TAG_CATEGORY: dict[str, str] = {tag: cat for cat, tags in TAG_CATEGORIES.items() for tag in tags}
TAG_CATEGORY_DEFAULT = "Other"

# Written forms that are not plain title case ("Python" needs no entry).
TAG_SPELLINGS: dict[str, str] = {
    "sql": "SQL", "sas": "SAS", "matlab": "MATLAB", "generative ai": "Generative AI", "llm": "LLM", "nlp": "NLP",
    "tensorflow": "TensorFlow", "pytorch": "PyTorch", "xgboost": "XGBoost", "lightgbm": "LightGBM",
    "langchain": "LangChain", "numpy": "NumPy", "scipy": "SciPy", "power bi": "Power BI", "aws": "AWS", "gcp": "GCP",
    "sagemaker": "SageMaker", "databricks": "DataBricks", "bigquery": "BigQuery", "postgresql": "PostgreSQL",
    "mysql": "MySQL", "mongodb": "MongoDB", "dbt": "DBT", "mlflow": "MLflow", "wandb": "W&B", "fastapi": "FastAPI",
}
TAG_DISPLAY: dict[str, str] = {tag: TAG_SPELLINGS.get(tag, tag.title()) for tag in TAXONOMY}
