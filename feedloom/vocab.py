"""Fixed values.

Everything in this module is data: word lists, lookup tables and patterns whose
exact contents decide results. Operators take them as default parameters, so a
caller can pass other lists.
"""

# --- fixed values: record shape ------------------------------------------------
FEED_COLUMNS = (
    "title",
    "year",
    "type",
    "platform",
    "release_date",
    "overview",
    "genres",
    "poster_image_url",
    "backdrop_image_url",
    "rating",
    "trailer_url",
    "source_url",
    "scraped_at",
    "source_name",
    "source_domain",
    "article_url",
    "content_type",
    "published_at",
    "updated_at",
)

UNKNOWN_TITLE = "Unknown Title"
NO_OVERVIEW = "Overview not available."
SUMMARY_CHARS = 500
FEED_CAP = 20
TOP_PER_TYPE = 10
MIN_QUALITY = 3

# --- fixed values: platforms and content types ---------------------------------
PLATFORMS = ("netflix", "disney_plus", "prime_video", "hbo_max", "cinema", "multi_platform")

PLATFORM_ALIASES = {
    "netflix": "netflix",
    "disney+": "disney_plus",
    "disney_plus": "disney_plus",
    "disney plus": "disney_plus",
    "prime video": "prime_video",
    "amazon prime": "prime_video",
    "amazon prime video": "prime_video",
    "prime_video": "prime_video",
    "hbo max": "hbo_max",
    "max": "hbo_max",
    "hbomax": "hbo_max",
    "hbo_max": "hbo_max",
    "cinema": "cinema",
    "theatrical": "cinema",
    "multi_platform": "multi_platform",
    "multi platform": "multi_platform",
}

CONTENT_TYPES = ("trending", "upcoming_release", "platform_release", "cinema_release", "review")

GENRE_NAMES = (
    "Action",
    "Adventure",
    "Animation",
    "Comedy",
    "Crime",
    "Documentary",
    "Drama",
    "Family",
    "Fantasy",
    "Horror",
    "Mystery",
    "Romance",
    "Sci-Fi",
    "Thriller",
)

GENRE_CODES = {
    "act": "Action",
    "adv": "Adventure",
    "ani": "Animation",
    "cmy": "Comedy",
    "crm": "Crime",
    "doc": "Documentary",
    "drm": "Drama",
    "fml": "Family",
    "fnt": "Fantasy",
    "hst": "History",
    "hrr": "Horror",
    "msc": "Music",
    "mys": "Mystery",
    "rma": "Romance",
    "scf": "Sci-Fi",
    "trl": "Thriller",
    "war": "War",
    "wsn": "Western",
    "eur": "European",
    "rly": "Reality",
    "spt": "Sport",
}

# --- fixed values: gates --------------------------------------------------------
RESERVED_TITLES = ("unknown title", "home", "video")
GENERIC_TITLES = ("breaking news", "news", "update", "latest updates")
CLICKBAIT = ("you won't believe", "shocking", "insane", "must see", "viral hack")
TRUSTED_DOMAIN_PARTS = (
    "netflix.com",
    "disney",
    "primevideo.com",
    "max.com",
    "imdb.com",
    "variety.com",
)

TOPIC_ALLOW = (
    "movie",
    "film",
    "series",
    "tv",
    "streaming",
    "trailer",
    "actor",
    "actress",
    "director",
    "cinema",
    "box office",
    "anime",
    "documentary",
    "episode",
    "season",
    "premiere",
    "netflix",
    "disney+",
    "prime video",
    "hbo max",
    "max original",
    "entertainment",
)

TOPIC_DENY = (
    "airpods",
    "deal",
    "discount",
    "baseball",
    "football",
    "soccer",
    "cricket",
    "tennis",
    "basketball",
    "nfl",
    "nba",
    "mlb",
    "ufc",
    "mma",
    "nascar",
    "schedule",
    "stock",
    "earnings",
    "finance",
    "crypto",
    "election",
    "senate",
    "policy",
    "war update",
)

UPCOMING_EXCLUDE = (
    "stock price",
    "quarterly earnings",
    "shares fell",
    "shares rose",
    "lawsuit filed",
    "sports schedule",
    "nfl draft",
    "nba trade",
)

STREAMING_SIGNALS = (
    "premiere",
    "premieres",
    "premiering",
    "season premiere",
    "series premiere",
    "release date",
    "releases on",
    "releasing on",
    "debuts",
    "debut",
    "new on ",
    "new to ",
    " arrives ",
    "arriving on",
    "arriving this",
    "coming to ",
    "starts streaming",
    "begins streaming",
    "begin streaming",
    "now streaming",
    "streaming on",
    "streaming this",
    "drop on",
    "drops on",
    "launches on",
    "launch on",
    "launching on",
    "due on",
    "due out",
    "slated for",
    "set for",
    "incoming",
    "exclusive release",
    "stream this",
    "streaming soon",
    "to stream",
    "this week",
    "this month",
    "added this week",
    "just added",
    "new episodes",
)

THEATRICAL_SIGNALS = (
    "theatrical",
    "theatrical release",
    "in theaters",
    "in theatres",
    "box office",
    "wide release",
    "limited release",
    "opening weekend",
    "opening day",
    "opening friday",
    "opens ",
    "opening ",
    "opens this week",
    "opens december",
    "opens january",
    "opens february",
    "opens march",
    "opens april",
    "opens may",
    "opens june",
    "opens july",
    "opens august",
    "opens september",
    "opens october",
    "opens november",
    "new movie",
    "new film",
    "coming to theaters",
    "coming to theatres",
    "cinema release",
    "theater release",
    "theatre release",
    "release this week",
    "release this month",
    "exclusive run",
    "film release",
    "movie release",
)

TRENDING_SIGNALS = (
    " trending",
    "trending on",
    "trending now",
    "trended",
    " viral",
    "viral ",
    "viral hit",
    "breakout ",
    "breakout hit",
    "streaming charts",
    "top 10",
    "tops the chart",
    "number one",
    "no. 1",
    " #1",
    "#1 ",
    "#1.",
    "#1:",
    "#1?",
    "#1;",
    "most-watched",
    "most watched",
    "viewership record",
    "rating record",
    "smash hit",
    "buzzworthy",
    "cultural moment",
    "this week",
    "this month",
)

# Shortest title of a feed that the registry does not list.
MIN_TITLE = 8


# --- fixed values: URLs and outlets ---------------------------------------------
TRACKING_PARAMS = (
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_term",
    "utm_content",
    "utm_id",
    "gclid",
    "fbclid",
    "mc_cid",
    "mc_eid",
    "_ga",
    "igshid",
    "ref",
    "ref_src",
    "ref_url",
    "cmpid",
)

APEX_DOMAINS = (
    "variety.com",
    "deadline.com",
    "hollywoodreporter.com",
    "screenrant.com",
    "collider.com",
    "indiewire.com",
    "thewrap.com",
    "rollingstone.com",
    "imdb.com",
    "amazon.com",
    "amazon.co.uk",
    "netflix.com",
    "disneyplus.com",
    "primevideo.com",
    "max.com",
)

# Outlet names for a whole host (leading "www." already removed).
OUTLETS_BY_HOST = {
    "variety.com": "Variety",
    "deadline.com": "Deadline",
    "hollywoodreporter.com": "The Hollywood Reporter",
    "screenrant.com": "ScreenRant",
    "collider.com": "Collider",
    "indiewire.com": "IndieWire",
    "thewrap.com": "TheWrap",
    "slashfilm.com": "SlashFilm",
    "ign.com": "IGN",
    "imdb.com": "IMDb",
    "netflix.com": "Netflix",
    "disneyplus.com": "Disney+",
    "primevideo.com": "Prime Video",
    "max.com": "Max",
    "hbomax.com": "HBO Max",
    "hbo.com": "HBO Max",
    "amazon.com": "Amazon",
    "amazon.co.uk": "Amazon",
    "news.google.com": "Google News",
    "rollingstone.com": "Rolling Stone",
    "theringer.com": "The Ringer",
    "vulture.com": "Vulture",
}

# Outlet names that also cover every subdomain.
OUTLETS_BY_SUFFIX = {
    "wbd.com": "Warner Bros. Discovery",
    "aboutamazon.com": "About Amazon",
    "screenhub.com.au": "ScreenHub Australia",
    "zoomtventertainment.com": "Zoom TV Entertainment",
    "aol.com": "AOL",
    "whky.com": "WHKY",
}

UK_SECOND_LEVEL = ("co", "com", "org", "net", "gov")
DROPPED_TLDS = ("com", "net", "org", "tv", "io", "co", "news")
ACRONYM_LABELS = ("aol", "whky", "bbc", "cnn", "mtv", "tmz", "abc", "nbc", "cbs")
LABEL_NAMES = {
    "economictimes": "Economic Times",
    "mensjournal": "Mens Journal",
    "screenhub": "ScreenHub",
    "aboutamazon": "About Amazon",
    "zoomtventertainment": "Zoom TV Entertainment",
}
LABEL_ENDINGS = (
    "news",
    "media",
    "times",
    "journal",
    "entertainment",
    "daily",
    "post",
    "insider",
)

AGGREGATOR_HOST = "news.google.com"
IMAGE_CDN_SUFFIXES = ("googleusercontent.com", "ggpht.com", "gstatic.com")

HUB_SEGMENTS = (
    "browse",
    "home",
    "us",
    "en",
    "gb",
    "fr",
    "de",
    "es",
    "it",
    "tv",
    "movies",
    "watch",
    "originals",
    "login",
    "signup",
    "search",
    "shop",
    "store",
    "help",
    "support",
    "download",
    "account",
    "profiles",
    "settings",
    "corporate",
    "press",
    "about",
    "news",
    "film",
    "sports",
)
SERVICE_ROOTS = ("browse", "login", "account", "profiles", "signup")

# --- fixed values: images --------------------------------------------------------
LOGO_ASSET_IDS = (
    "J6_coFbogxhRI9iM864NL_liGXvsQp2AupsKei7z0cNNfDvGUmWUy20nuUhkREQyrpY4bEeIBuc",
)
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".gif", ".avif")
IMAGE_FORMAT_HINTS = (
    "format=webp",
    "format=jpeg",
    "format=jpg",
    "format=pjpeg",
    "format=png",
    "/ripcut-delivery/",
)
IMAGE_HOST_PARTS = (
    "variety.com",
    "tmdb.org",
    "image.tmdb.org",
    "imdb.com",
    "netflix.com",
    "nflximg.net",
    "nflxext.com",
    "disney",
    "amazon",
    "brightspotcdn",
    "brightspot",
    "bamgrid.com",
    "max.com",
    "hbo",
    "googleusercontent.com",
    "ggpht.com",
    "turner.com",
    "wbd.",
    "press.wbd",
    "wordpress.com",
    "wp.com",
    "squarespace",
    "wikimedia.org",
    "cdn",
    "image",
    "img",
)
PLACEHOLDER_PARTS = (
    "placeholder",
    "/1x1",
    "1x1.",
    "blank.gif",
    "pixel.gif",
    "spacer.gif",
    "/clear.gif",
    "transparent.gif",
    "default-avatar",
    "anonymous.png",
    "no-image",
    "missing-image",
    "image-not-found",
)

# --- fixed values: URL templates and landmark texts of the source formats --------
META_IMAGE_PATTERNS = (
    r"""<meta[^>]+property=["']og:image["'][^>]+content=["']([^"']+)["']""",
    r"""<meta[^>]+name=["']twitter:image["'][^>]+content=["']([^"']+)["']""",
    r"""<meta[^>]+content=["']([^"']+)["'][^>]+property=["']og:image["']""",
    r"""<meta[^>]+content=["']([^"']+)["'][^>]+name=["']twitter:image["']""",
)
CANONICAL_LINK_PATTERNS = (
    r"""<link[^>]+rel=["']canonical["'][^>]*href=["']([^"']+)["'][^>]*>""",
    r"""<link[^>]+href=["']([^"']+)["'][^>]*rel=["']canonical["'][^>]*>""",
)
OG_URL_PATTERNS = (
    r"""<meta[^>]+property=["']og:url["'][^>]+content=["']([^"']+)["']""",
    r"""<meta[^>]+content=["']([^"']+)["'][^>]+property=["']og:url["']""",
)
PAGE_STATE_PATTERN = r"""<script id="__NEXT_DATA__" type="application/json">(.+?)</script>"""
WATCH_URL = "https://www.netflix.com/watch/"
CARD_LIST_URL = "https://ondisneyplus.disney.com/recent-releases"
CARD_IMAGE_URL = "https://disney.images.edge.bamgrid.com/ripcut-delivery/v2/variant/disney/"
CARD_IMAGE_ARGS = "/compose?format=webp&width=440"
CARD_PATH_PREFIX = "/whats-on/"
TITLE_HOST = "https://www.imdb.com"
CHART_HOST = "https://www.boxofficemojo.com"
CHART_LINK_PART = "/release/"
LISTING_HOST = "https://www.justwatch.com"
LISTING_IMAGE_HOST = "https://images.justwatch.com"
LISTING_IMAGE_PROFILE = "s592"
LISTING_IMAGE_FORMAT = "webp"
CATALOG_IMAGE_BASE = "https://image.tmdb.org/t/p/"
CATALOG_IMAGE_PATTERN = r"/t/p/w\d+(?:_and_h\d+_\w+)?(/[a-zA-Z0-9]+\.jpg)"
POSTER_SIZE = "w500"
BACKDROP_SIZE = "w1280"
DETAIL_POSTER_PART = "m.media-amazon.com/images/M/"
DETAIL_POSTER_RENDITION = "._V1_QL75_UX380_.jpg"
DETAIL_LABELS = ("Release Date", "MPAA")

# Patterns of the search-title clean-up, applied in this order.
SEARCH_TRAILING_NOISE = (
    r"\s*[-–—|:]\s*("
    r"netflix|hulu|disney\+?|prime video|amazon|hbo max|max|peacock|"
    r"apple tv\+?|paramount\+?|abc|cbs|nbc|fox|"
    r"official trailer|trailer|teaser|first look|watch now!?"
    r").*$"
)
SEARCH_SEASON = r"\bseason\s+\d+\b"
SEARCH_SUFFIXES = (
    r"\s+("
    r"is\s+filming\s+now|is\s+coming\s+back|is\s+back\b.*|"
    r"teaser\s+trailer\b.*|official\s+trailer\b.*|trailer\b.*|"
    r"first\s+look\b.*|gets?\s+(a\s+)?new\s+trailer\b.*|"
    r"holds?\s+wonders?\b.*|reveals?\s+the\b.*|reveals?\s+.*|"
    r"examines?\s+the\b.*|examines?\s+.*|"
    r"debuts?\s+trailer\b.*|debuts?\b.*|"
    r"where\s+will\b.*|"
    r"here'?s\s+the\s+cast\b.*|"
    r"announces?\b.*|every\b.*"
    r")$"
)
SEARCH_PREFIXES = (
    r"^("
    r"watch\s+[\w\s]+?\s+in\s+|watch\s+|"
    r"dive\s+in\s+to\s+(all\s+)?the\s+|"
    r"from\s+page\s+to\s+screen:\s*|"
    r"here'?s?\s+(what|the|every)\b.*?:\s*|"
    r"\d+\s+shows?\s+\w+\s+in\s+\d{4}\s+by\s+"
    r")"
)
QUOTED_TITLE = (
    r"[‘’“”'\"]+([^‘’“”'\"]{3,})[‘’“”'\"]+"
)
SERVICE_TITLE_TAIL = r"\s*[-|]\s*(netflix|disney\+?|prime video|max|hbo max|tudum).*$"
CHART_RANK_PREFIX = r"^\d+\s+"
CHART_SEASON_SUFFIX = r"(:\s*)?(Season\s+\d+|Limited Series|Series)\s*$"

# --- fixed values: dates ----------------------------------------------------------
# Offsets of the zone names that mail-style dates may carry, in minutes.
ZONE_MINUTES = {
    "UT": 0,
    "UTC": 0,
    "GMT": 0,
    "Z": 0,
    "AST": -240,
    "ADT": -180,
    "EST": -300,
    "EDT": -240,
    "CST": -360,
    "CDT": -300,
    "MST": -420,
    "MDT": -360,
    "PST": -480,
    "PDT": -420,
}
MONTHS = (
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
)
