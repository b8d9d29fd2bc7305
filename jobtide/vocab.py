"""Fixed values of the domain. They decide results, so they are stated plainly."""

from __future__ import annotations

from pathlib import Path

SEED_DIR = Path(__file__).parent / "seeds"

# --- fixed values: skill spelling -> canonical technology -------------------
TECH_ALIASES = {
    "python": "Python",
    "python3": "Python",
    "py": "Python",
    "javascript": "JavaScript",
    "js": "JavaScript",
    "typescript": "TypeScript",
    "ts": "TypeScript",
    "react": "React",
    "react.js": "React",
    "reactjs": "React",
    "node": "Node.js",
    "node.js": "Node.js",
    "nodejs": "Node.js",
    "sql": "SQL",
    "t-sql": "SQL",
    "pl/sql": "SQL",
    "spark": "Apache Spark",
    "apache spark": "Apache Spark",
    "pyspark": "Apache Spark",
    "airflow": "Apache Airflow",
    "apache airflow": "Apache Airflow",
    "kafka": "Apache Kafka",
    "apache kafka": "Apache Kafka",
    "dbt": "dbt",
    "data build tool": "dbt",
    "aws": "AWS",
    "amazon web services": "AWS",
    "gcp": "GCP",
    "google cloud": "GCP",
    "google cloud platform": "GCP",
    "azure": "Azure",
    "microsoft azure": "Azure",
    "postgresql": "PostgreSQL",
    "postgres": "PostgreSQL",
    "mysql": "MySQL",
    "mongodb": "MongoDB",
    "mongo": "MongoDB",
    "redis": "Redis",
    "docker": "Docker",
    "kubernetes": "Kubernetes",
    "k8s": "Kubernetes",
    "terraform": "Terraform",
    "git": "Git",
    "java": "Java",
    "scala": "Scala",
    "go": "Go",
    "golang": "Go",
    "databricks": "Databricks",
    "power bi": "Power BI",
    "powerbi": "Power BI",
    "tableau": "Tableau",
    "linux": "Linux",
}
CANONICAL_TECHS = sorted(set(TECH_ALIASES.values()))

# --- fixed values: names a user may type for a technology filter -------------
KNOWN_TECHS = [
    "Python", "Java", "JavaScript", "TypeScript", "C#", "C++", "Go", "Rust", "Kotlin", "Swift",
    "PHP", "Ruby", "Scala", "R",
    "React", "Angular", "Vue.js", "Next.js", "HTML", "CSS", "Tailwind", "Svelte",
    "Node.js", "Spring", "Django", "FastAPI", "Flask", ".NET", "Express", "NestJS", "Laravel",
    "SQL", "Apache Spark", "Apache Kafka", "Apache Airflow", "dbt", "Pandas", "PySpark",
    "Snowflake", "Databricks", "Power BI", "Tableau",
    "AWS", "Azure", "GCP", "Docker", "Kubernetes", "Terraform", "Ansible", "Jenkins",
    "GitLab CI", "GitHub Actions", "Linux",
    "PostgreSQL", "MySQL", "MongoDB", "Redis", "Elasticsearch", "Oracle", "MS SQL",
    "Cassandra", "DynamoDB",
    "TensorFlow", "PyTorch", "MLflow", "scikit-learn", "LLM", "OpenAI", "Hugging Face", "NLP",
    "Computer Vision",
    "React Native", "Flutter", "iOS", "Android", "SwiftUI", "Jetpack Compose",
    "Selenium", "Cypress", "Jest", "Playwright", "JUnit", "pytest",
    "OWASP", "Penetration Testing", "SIEM", "SOC", "Firewall", "IAM",
]

# --- fixed values: city names offered for the location filter ----------------
KNOWN_CITIES = [
    "Białystok", "Bielsko-Biała", "Bydgoszcz", "Częstochowa", "Gdańsk", "Gdynia", "Gliwice",
    "Gorzów Wielkopolski", "Katowice", "Kielce", "Kraków", "Lublin", "Łódź", "Nowy Sącz",
    "Olsztyn", "Opole", "Poznań", "Płock", "Radom", "Rzeszów", "Rybnik", "Sopot", "Sosnowiec",
    "Szczecin", "Toruń", "Trójmiasto", "Warszawa", "Warsaw", "Wrocław", "Zabrze",
    "Zielona Góra", "Remote", "Polska",
]

# --- fixed values: filter dimensions and their defaults ----------------------
SENIORITIES = ["intern", "junior", "mid", "senior", "lead", "manager", "c_level"]
CATEGORIES = [
    "python", "java", "javascript", "net", "c", "go", "php", "html", "mobile", "data", "ai",
    "devops", "admin", "security", "testing", "pm", "analytics", "architecture", "erp",
    "support", "other",
]
WORKPLACES = ["remote", "hybrid", "office"]
EMPLOYMENT_TYPES = ["b2b", "permanent", "mandate_contract", "any"]
DEFAULT_CONFIG = {
    "seniorities": SENIORITIES,
    "technologies": [],
    "categories": CATEGORIES,
    "workplace_types": WORKPLACES,
    "employment_types": EMPLOYMENT_TYPES,
    "salary_min": 0,
    "cities": [],
    "tolerance": 1,
}

# --- fixed values: pay period -> factor to a monthly amount ------------------
PAY_FACTORS = {
    "hour": 168.0,
    "hourly": 168.0,
    "day": 21.0,
    "daily": 21.0,
    "week": 4.33,
    "weekly": 4.33,
    "year": 1.0 / 12.0,
    "annually": 1.0 / 12.0,
    "annum": 1.0 / 12.0,
}

# --- fixed values: contract basis --------------------------------------------
MONTHLY_TYPES = ["permanent", "any"]
BASIS_LABELS = {
    "permanent": "Permanent (UoP)",
    "b2b": "B2B",
    "mandate": "Mandate (zlecenie)",
}

# --- fixed values: subscription tiers and their life cycle -------------------
PLUS_FEATURES = ["filter_push", "latest", "salary", "trend"]
PRO_FEATURES = PLUS_FEATURES + ["skills", "company", "export", "tracker", "report"]
TIERS = {
    "plus": {"stars": 250, "days": 30, "rank": 1, "max_listings": 50, "features": PLUS_FEATURES},
    "pro": {"stars": 600, "days": 30, "rank": 2, "max_listings": 100, "features": PRO_FEATURES},
}
FREE_CAP = 20
TRIAL_TIER = "plus"
TRIAL_DAYS = 1
GRACE_DAYS = 3
REMIND_DAYS = 3
REMIND_COOLDOWN_SECONDS = 20 * 3600

# --- fixed values: misc ------------------------------------------------------
TRACKER_STATUSES = ["applied", "interested", "rejected"]
WORKPLACE_ACCEPTED = ["remote", "hybrid", "onsite"]
EXPORT_FIELDS = [
    "listing_id", "title", "company_name", "seniority", "employment_type", "workplace_type",
    "category", "salary_min", "salary_max", "currency", "cities", "technologies", "slug",
]
OFFER_URL = "https://justjoin.it/offers/"
POOL_SIZE = 500
RAW_POOL_SIZE = 200
STALE_SECONDS = 24 * 3600
NULL_KEY = "_null_key_"
