"""Fixed schemas as DDL text: source payloads, Bronze, Silver, companies, run events. Nothing is inferred on read."""

from __future__ import annotations

FIELDS = [
    "title",
    "company_name",
    "company_domain",
    "location_city",
    "location_state",
    "location_country",
    "is_remote",
    "employment_type",
    "salary_min",
    "salary_max",
    "salary_currency",
    "salary_period",
    "job_description",
    "job_apply_link",
    "employer_logo",
    "posted_at",
]
RAW_FIELDS = [f"{f}_raw" for f in FIELDS]
RAW_TYPES = {"is_remote_raw": "boolean", "salary_min_raw": "double", "salary_max_raw": "double"}
DERIVED_FIELDS = ["skills_tags", "years_experience_min", "seniority"]

BRONZE_DDL = "job_id string, " + ", ".join(f"{f} {RAW_TYPES.get(f, 'string')}" for f in RAW_FIELDS)
SILVER_DDL = (
    "title string, company_name string, company_domain string, location_city string, location_state string, "
    "location_country string, is_remote boolean, employment_type string, salary_min double, salary_max double, "
    "salary_currency string, salary_period string, job_description string, job_apply_link string, "
    "employer_logo string, posted_at timestamp, skills_tags array<string>, years_experience_min int, seniority string"
)
COMPANIES_DDL = (
    "domain string, name string, industry string, employee_count int, employee_range string, linkedin_url string, "
    "website_url string, city string, country string, created_at timestamp, updated_at timestamp"
)
RUN_EVENTS_DDL = (
    "run_id string, event_at timestamp, status string, jobs_fetched bigint, jobs_new bigint, jobs_skipped bigint, "
    "jobs_duplicate bigint, companies_added bigint, error_message string, duration_seconds double, jobs_rejected bigint"
)

JSEARCH_ITEM_DDL = (
    "struct<job_id: string, job_title: string, employer_name: string, employer_website: string, job_city: string, "
    "job_state: string, job_country: string, job_is_remote: boolean, job_employment_type: string, "
    "job_min_salary: double, job_max_salary: double, job_salary_currency: string, job_salary_period: string, "
    "job_description: string, job_apply_link: string, employer_logo: string, job_posted_at_datetime_utc: string>"
)
ADZUNA_ITEM_DDL = (
    "struct<id: string, title: string, company: struct<display_name: string>, "
    "location: struct<area: array<string>, display_name: string>, description: string, redirect_url: string, "
    "salary_min: double, salary_max: double, contract_time: string, created: string>"
)
THEIRSTACK_ITEM_DDL = (
    "struct<id: string, job_title: string, company_name: string, company_url: string, company_logo: string, "
    "city: string, state: string, country: string, remote: boolean, employment_type: string, salary_min: double, "
    "salary_max: double, salary_currency: string, salary_period: string, description: string, url: string, "
    "date_posted: string>"
)
SERPAPI_ITEM_DDL = (
    "struct<job_id: string, title: string, company_name: string, location: string, description: string, "
    "thumbnail: string, apply_options: array<struct<link: string, title: string>>, "
    "detected_extensions: struct<schedule_type: string, work_from_home: boolean, posted_at: string, salary: string>>"
)

JSEARCH_PAGE_DDL = f"data array<{JSEARCH_ITEM_DDL}>"
ADZUNA_PAGE_DDL = f"results array<{ADZUNA_ITEM_DDL}>"
THEIRSTACK_PAGE_DDL = f"data array<{THEIRSTACK_ITEM_DDL}>, total bigint"
SERPAPI_PAGE_DDL = (
    f"jobs_results array<{SERPAPI_ITEM_DDL}>, serpapi_pagination struct<next_page_token: string>"
)
