"""The sentiment lexicon and sector keywords (fixed values), and a loader for lists of one's own."""

from __future__ import annotations

from pitpanel.config import read_settings

# Fixed values.
POSITIVE = [
    "naik", "menguat", "melonjak", "melesat", "meroket", "tumbuh", "pertumbuhan", "untung", "laba", "cuan", "surplus", "rekor",
    "positif", "optimis", "optimistis", "membaik", "pulih", "pemulihan", "ekspansi", "dividen", "apresiasi", "terdongkrak",
    "berkembang", "prospektif", "stabil", "kokoh", "solid", "bullish", "akumulasi", "penguatan", "kenaikan", "peluang",
    "insentif", "efisien", "terkendali", "gain", "gains", "rally", "surge", "soar", "soars", "jump", "jumps", "rise", "rises",
    "climb", "climbs", "record", "profit", "profits", "growth", "upbeat", "beat", "beats", "strong", "strength", "recovery",
    "recovers", "rebound", "upgrade", "upgraded", "outperform", "buy", "expansion", "improve", "improves", "improved", "positive",
    "optimistic", "boom", "boost", "boosts", "higher",
]
NEGATIVE = [
    "turun", "melemah", "anjlok", "ambles", "ambruk", "merosot", "tergelincir", "rugi", "kerugian", "defisit", "negatif",
    "pesimis", "pesimistis", "memburuk", "lesu", "loyo", "krisis", "resesi", "gagal", "pailit", "bangkrut", "utang", "koreksi",
    "tekanan", "tertekan", "suspensi", "delisting", "penurunan", "pelemahan", "kekhawatiran", "waspada", "ancaman", "bearish",
    "jual", "phk", "tumbang", "fall", "falls", "drop", "drops", "plunge", "plunges", "slump", "slumps", "sink", "sinks", "tumble",
    "tumbles", "decline", "declines", "loss", "losses", "weak", "weakness", "miss", "misses", "fear", "fears", "risk", "risks",
    "recession", "crisis", "default", "bankrupt", "bankruptcy", "downgrade", "downgraded", "underperform", "sell", "selloff",
    "crash", "warning", "warns", "lower", "concern", "concerns", "negative", "pessimistic", "inflasi tinggi", "gagal bayar",
]
NEGATIONS = [
    "tidak", "bukan", "tak", "belum", "tanpa", "not", "no", "never", "without",
]
SECTOR_KEYWORDS = {
    "Energy": ["batu bara", "batubara", "coal", "minyak", "oil", "migas", "gas", "energi", "energy", "opec"],
    "Basic Materials": ["nikel", "nickel", "emas", "gold", "tembaga", "copper", "timah", "tin", "smelter", "tambang", "mining", "semen", "cement", "pulp", "kertas", "petrokimia"],
    "Financial Services": ["bank", "perbankan", "banking", "kredit", "lending", "suku bunga", "interest rate", "asuransi", "insurance", "multifinance"],
    "Consumer Cyclical": ["ritel", "retail", "otomotif", "automotive", "mall", "e-commerce", "fashion"],
    "Consumer Defensive": ["sawit", "cpo", "palm oil", "pangan", "makanan", "minuman", "fmcg", "consumer goods", "rokok", "tobacco"],
    "Communication Services": ["telekomunikasi", "telco", "telecom", "media", "internet", "seluler"],
    "Industrials": ["konstruksi", "construction", "infrastruktur", "infrastructure", "alat berat", "manufaktur", "manufacturing", "logistik", "kontraktor"],
    "Technology": ["teknologi", "technology", "startup", "digital", "fintech", "software"],
    "Healthcare": ["kesehatan", "rumah sakit", "hospital", "farmasi", "pharma", "obat"],
    "Real Estate": ["properti", "property", "real estate", "apartemen", "perumahan", "kawasan industri"],
    "Utilities": ["listrik", "electricity", "pembangkit", "power plant", "utilitas"],
}


def words(items) -> list[str]:
    """Lower case; truth values that a parser made of the words no and yes become words again."""
    return ["no" if w is False else "yes" if w is True else str(w).lower() for w in items or ()]


def load_lexicon(path: str | None = None) -> dict:
    """The lists above, or those of a JSON or YAML file."""
    given = read_settings(path) if path else {"positive": POSITIVE, "negative": NEGATIVE, "negations": NEGATIONS, "sector_keywords": SECTOR_KEYWORDS}
    out = {k: words(given.get(k)) for k in ("positive", "negative", "negations")}
    return out | {"sector_keywords": {s: sorted(set(words(w))) for s, w in (given.get("sector_keywords") or {}).items()}}
