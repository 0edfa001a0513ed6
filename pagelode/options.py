"""Options of the crawl and of the search. Every function takes them as plain arguments too."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

# These lists decide results, so they are stated as they are.
VALID_DOMAINS = ("wikipedia.org", "arxiv.org", ".edu")
TRUSTED_DOMAINS = ("wikipedia.org", "arxiv.org", ".edu")
JUNK_PATTERNS = (
    "login", "signin", "signup", "register", "special:", "user:", "user_talk:", "talk:",
    "edit", "history", "file:", "category:",
)
BLOCKED_EXTENSIONS = (
    "jpg", "jpeg", "png", "gif", "svg", "pdf", "zip", "mp4", "mp3", "webp",
)
BLOCKED_NAMESPACES = (
    "category:", "file:", "template:", "portal:", "user:", "user_talk:", "wikipedia:",
    "help:", "special:",
)
START_URLS = (
    "https://en.wikipedia.org/wiki/Main_Page",
    "https://en.wikipedia.org/wiki/Mathematics",
    "https://en.wikipedia.org/wiki/Physics",
    "https://en.wikipedia.org/wiki/Computer_science",
    "https://en.wikipedia.org/wiki/India",
    "https://en.wikipedia.org/wiki/Artificial_intelligence",
    "https://en.wikipedia.org/wiki/World_War_II",
)
MAX_URL_LENGTH = 200
MAX_URLS_PER_PAGE = 50
ROBOTS_AGENT = "MiniSearchBot"


# Section and name, in a settings file, of what the options call otherwise.
SETTING_NAMES = {
    "url_batch_size": ("kafka", "batch_size"),
    "bulk_size": ("elasticsearch", "bulk_size"),
    "lease_seconds": ("redis", "lease_seconds"),
    "domain_budgets": ("domains", "budgets"),
}


# The defaults decide results.
@dataclass(frozen=True)
class CrawlOptions:
    start_urls: tuple[str, ...] = START_URLS
    max_pages: int = 1_000_000
    max_depth: int = 3
    worker_batch_size: int = 25
    max_frontier_queue_size: int = 200_000
    priority_enabled: bool = True
    domain_max_requests_default: int = 1000
    per_domain_delay_seconds: float = 2.0
    robots_ttl_seconds: int = 3600
    retry_attempts: int = 3
    url_batch_size: int = 25
    bulk_size: int = 500
    lease_seconds: int = 300
    domain_budgets: dict = field(default_factory=dict)
    valid_domains: tuple[str, ...] = VALID_DOMAINS
    junk_patterns: tuple[str, ...] = JUNK_PATTERNS
    max_urls_per_page: int = MAX_URLS_PER_PAGE
    robots_agent: str = ROBOTS_AGENT
    article_bonus: str = "whole"


@dataclass(frozen=True)
class SearchOptions:
    title_boost: float = 2.0
    k1: float = 1.2
    b: float = 0.75
    max_expansions: int = 50
    pool_size: int = 50
    result_size: int = 10
    preview_chars: int = 200
    trusted_domains: tuple[str, ...] = TRUSTED_DOMAINS


def options_from(settings: dict | None, base: CrawlOptions = CrawlOptions()) -> CrawlOptions:
    """Options from the parsed contents of a settings file, over `base`.

    The crawl's own names stand in a section `crawler`, or all at the top, where that section is
    then not looked at. Missing and unknown names change nothing.
    """
    settings = settings or {}
    names = {f.name for f in fields(CrawlOptions)} - set(SETTING_NAMES)
    own = settings if names & set(settings) else settings.get("crawler") or {}
    found = {name: own[name] for name in names & set(own)}
    for name, (section, key) in SETTING_NAMES.items():
        if key in (settings.get(section) or {}):
            found[name] = settings[section][key]
    return replace(base, **{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})
