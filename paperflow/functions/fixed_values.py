"""These must equal the published feed's own values for right results.

Word lists, lookup tables, formats and thresholds only; no logic lives here.
"""

# --- fixed values: tracked listing categories and their badges, in priority order
CATEGORIES = ("cs.LG", "cs.CV", "cs.AI", "eess.IV", "eess.SP")
BADGES = {
    "cs.LG": "LG",
    "cs.CV": "CV",
    "cs.AI": "AI",
    "eess.IV": "IV",
    "eess.SP": "SP",
}
SOURCE_BADGES = {"crossref": "JNL", "openalex": "OAX"}
UNKNOWN_BADGE = "?"

# --- fixed values: topic buckets in tie-break order, each with its keywords
BUCKETS = (
    ("Fourier Ptychography/Microscopy", (
        "fourier ptychography", "ptychograph", "ptychographic", "computational microscopy",
        "aperture synthesis", "synthetic aperture", "coded illumination",
        "illumination multiplexing", "high-resolution microscopy", "quantitative microscopy",
    )),
    ("Lensless/Coded Imaging", (
        "lensless", "coded aperture", "point spread function", "psf engineering",
        "diffuser", "mask-based", "single-shot imaging", "computational camera",
        "coded exposure", "snapshot imaging",
    )),
    ("Phase Imaging/Holography", (
        "quantitative phase", "phase retrieval", "phase imaging", "phase microscopy",
        "holography", "holographic", "computer-generated holography", "digital holography",
        "wavefront", "interferometry", "angular spectrum", "diffraction model",
    )),
    ("Meta-Optics/Diffractive", (
        "metasurface", "metalens", "meta-optics", "metaoptics", "diffractive optics",
        "nanophotonic", "flat optics", "inverse lithography", "freeform optics",
        "optical inverse design", "diffractive neural network",
    )),
    ("Light-Field/Novel Sensors", (
        "light field", "light-field", "plenoptic", "event camera", "event-based",
        "neuromorphic", "spike camera", "integral imaging", "light-field display",
    )),
    ("Tomography/3D Imaging", (
        "tomography", "tomographic", "optical diffraction tomography", "diffraction tomography",
        "volumetric imaging", "3d reconstruction", "gaussian splatting", "nerf",
        "neural radiance", "light-field microscopy", "refractive index tomography",
    )),
    ("Virtual Staining/Pathology", (
        "virtual staining", "digital pathology", "histopathology", "label-free",
        "stain", "whole slide", "tissue imaging", "cytology", "h&e",
    )),
    ("Reconstruction/Inverse Problems", (
        "image reconstruction", "inverse problem", "deep unfolding", "unrolling", "unrolled",
        "plug-and-play", "compressed sensing", "deconvolution", "computational imaging",
        "model-based", "regularization", "physics-informed",
    )),
    ("Deep Learning Methods", (
        "diffusion model", "generative model", "neural network", "deep learning",
        "self-supervised", "foundation model", "transformer", "implicit neural representation",
        "super-resolution", "denoising", "image restoration", "representation learning",
    )),
)
CATCH_ALL_BUCKET = "Deep Learning Methods"
WATCHED_BUCKETS = (
    "Lensless/Coded Imaging", "Virtual Staining/Pathology",
    "Light-Field/Novel Sensors", "Meta-Optics/Diffractive",
)

# --- fixed values: DOI prefixes removed when a DOI is reduced to its bare form
DOI_PREFIXES = ("https://doi.org/", "http://dx.doi.org/")
DOI_URL = "https://doi.org/"
ABS_URL = "https://arxiv.org/abs/"

# --- fixed values: day and month names used by labels
DAYS_SHORT = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
DAYS_LOCAL = ("월", "화", "수", "목", "금", "토", "일")
FEED_ZONE = "+0900"
FEED_HOUR = 9

# --- fixed values: trailing windows of the daily series, in days
TRAILING_WINDOWS = (
    ("1개월", 31), ("3개월", 92), ("6개월", 183),
    ("1년", 366), ("2년", 731), ("3년", 1096),
)

# --- fixed values: release checks
LISTING_SCOPE = "new+cross"
RELEASE_SCOPE = "new+cross; replacements excluded"
SOURCE_MODES = ("new", "pastweek-date-section", "journal-only")
POST_MARKERS = ("Cluster</th>", "대표 논문", "왜 중요?")
BANNED_PHRASES = (
    "정조준", "표면화", "batch", "압력이 걸려", "paradigm", "substrate", "audit",
    "측 결", "응용 결", "개별 처방", "각자 처방", "catalog 단계", "통합 매핑", "진짜 bottleneck",
)
MIN_CLUSTERS = 3
MAX_REUSED_TITLES = 4
CHECKED_CLUSTERS = 6
MIN_CLUSTER_PAPERS = 2
MIN_WHY_CHARS = 80
MIN_LISTED = 50
MIN_SELECTED_SHARE = 0.4

# --- fixed values: feed limits and digest lengths
FEED_ITEMS = 60
FEED_SUMMARY_CHARS = 380
ENTRY_SUMMARY_CHARS = 300
META_CHARS = 200
CONCEPT_LIMIT = 5
CONCEPT_MIN_SCORE = 0.3
SUMMARY_HEADING = "주간 동향"
ENTRY_SUMMARY_PATTERNS = (
    r"결론[^<]*</h2>\s*<[^>]*>(.*?)</(?:div|p)",
    r"Executive Summary[^<]*</h2>\s*<[^>]*>(.*?)</(?:div|p)",
    r"class=thesis[^>]*>(.*?)</div",
    r"주간 동향.*?</h2>\s*<p[^>]*>(.*?)</p>",
)
POST_NAME = r"^(\d{4}-\d{2}-\d{2})(-weekly)?\.html$"

# --- fixed values: markup of a landed listing page
LISTING_HEADER = r"<h3[^>]*>([^<]+)</h3>"
DATE_HEADER = r"<h3[^>]*>(.*?)</h3>"
LISTING_CHUNK = r"""<dt>\s*<a\s+name=["']item"""
LISTING_ID = r"""href\s*=\s*["']/abs/([^"']+)["']"""
LISTING_TITLE = r"list-title[^>]*>\s*<span[^>]*>Title:</span>\s*(.*?)\s*</div>"
LISTING_AUTHORS = r"list-authors[^>]*>(.*?)</div>"
LISTING_AUTHORS_PREFIX = r"<span[^>]*>Authors:</span>\s*"
LISTING_AUTHOR = r"<a[^>]*>(.*?)</a>"
LISTING_SUBJECTS = r"list-subjects[^>]*>\s*<span[^>]*>Subjects:</span>\s*(.*?)\s*</div>"
LISTING_ABSTRACT = r"""<p class=['"]mathjax['"][^>]*>(.*?)</p>"""
PRIMARY_CATEGORY = r"([a-z\-]+\.[A-Z]{2})"
DATED_SECTION = r"^(mon|tue|wed|thu|fri|sat|sun),\s+\d"
ABS_ID = r"arxiv\.org/abs/([0-9.]+)"
