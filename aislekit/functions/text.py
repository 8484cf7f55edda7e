"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["slugify", "parse_net_content", "parse_pack_quantity", "discount_code",
           "bundle_quantity", "search_terms", "normalise_pack_size", "normalise_unit",
           "normalise_case", "normalise_separators", "canonical_descriptors",
           "scraped_name_normalise", "product_name", "rating_sentiment", "typo_fold",
           "map_tokens", "DESCRIPTOR_SYNONYMS", "NAME_PATTERNS", "render_name_pattern", "default_folds"]


def slugify(text: Column) -> Column:
    """lower, '&' -> 'and', drop non-word characters, whitespace -> '-'.
    ``(?U)`` makes ``\\w`` and ``\\s`` Unicode-aware, as in Python."""
    t = F.regexp_replace(F.lower(text), "&", "and")
    t = F.regexp_replace(t, r"(?U)[^\w\s-]", "")
    return F.regexp_replace(t, r"(?U)\s+", "-")


def parse_net_content(net: Column) -> Column:
    """'Loose' -> 1; kg x 1000, g, ml, l x 1000 (checked in that order)."""
    s = F.trim(F.lower(net))

    def head(k: int) -> Column:
        return F.trim(s.substr(F.lit(1), F.length(s) - k)).try_cast("double")

    return (F.when(net.isNull(), F.lit(None).cast("double"))
            .when(net == "Loose", F.lit(1.0))
            .when(s.endswith("kg"), head(2) * 1000)
            .when(s.endswith("g"), head(1))
            .when(s.endswith("ml"), head(2))
            .when(s.endswith("l"), head(1) * 1000))


def parse_pack_quantity(pack: Column) -> Column:
    """leading '(\\d+)-pack' -> that number, else 1 (null -> 1)."""
    n = F.regexp_extract(pack, r"^(\d+)-pack", 1)
    return F.when(pack.isNull() | (n == ""), F.lit(1)).otherwise(n.cast("int"))


def discount_code(mechanic: Column, scope: Column, target: Column, value: Column,
                  campaign: Column | None = None, category_codes: Column | None = None) -> Column:
    """campaign, MECHANIC, target (categories through a code map),
    integer value (none for free shipping), joined with '_'; absent parts
    are skipped."""
    tgt = F.when(scope == "category", category_codes[target] if category_codes is not None else target) \
        .otherwise(target)
    val = F.when((mechanic != "free_shipping") & value.isNotNull() & (value != 0),
                 F.floor(value).cast("long").cast("string"))
    parts = ([F.nullif(campaign.cast("string"), F.lit(""))] if campaign is not None else []) + \
        [F.upper(mechanic), F.nullif(tgt.cast("string"), F.lit("")), val]
    return F.concat_ws("_", *parts)


def bundle_quantity(name: Column) -> Column:
    """'Buy (\\d+)' -> that number, else 1."""
    n = F.regexp_extract(name, r"Buy (\d+)", 1)
    return F.when(n == "", F.lit(1)).otherwise(n.cast("int"))


def search_terms(text: Column) -> Column:
    """every 1- and 2-word window of the text ('&' tokens dropped),
    words joined with '+'.  Returns array<string>; explode for rows."""
    words = F.filter(F.split(F.trim(text), r"\s+"), lambda w: (w != "&") & (w != ""))
    n = F.size(words)
    ones = F.transform(words, lambda w: F.regexp_replace(w, "&", ""))
    twos = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                       lambda i: F.concat_ws("+", F.slice(words, i, 2)))
    pairs = F.when(n >= 2, F.transform(twos, lambda s: F.regexp_replace(s, "&", ""))) \
        .otherwise(F.array().cast("array<string>"))
    return F.filter(F.concat(ones, pairs), lambda s: s != "")


def normalise_pack_size(name: Column) -> Column:
    """'6-pack', '6pk', '6 x', '6x' -> '6-pack'; '500 g' -> '500g'."""
    t = F.regexp_replace(name, r"(?i)\b(\d+)\s*(?:-\s*pack|pk|x)\b", "$1-pack")
    return F.regexp_replace(t, r"(?i)\b(\d+(?:\.\d+)?)\s+(kg|g|ml|l)\b", "$1$2")


def normalise_unit(name: Column) -> Column:
    """F32: 1000g -> 1kg and 1000ml -> 1L (one canonical form)."""
    t = F.regexp_replace(name, r"(?i)\b1000\s*g\b", "1kg")
    return F.regexp_replace(t, r"(?i)\b1000\s*ml\b", "1L")


def normalise_case(name: Column, brand: Column | None = None) -> Column:
    """fold upper / lower / title drift to title case, and drop a
    leading brand word when the brand is given."""
    t = F.initcap(F.lower(F.trim(name)))
    if brand is not None:
        t = F.when(brand.isNotNull() & F.lower(t).startswith(F.concat(F.lower(brand), F.lit(" "))),
                   t.substr(F.length(brand) + 2, F.length(t))).otherwise(t)
    return t


def normalise_separators(name: Column) -> Column:
    """'_', '-', '.', and "'" become spaces; whitespace squeezed."""
    t = F.translate(name, "_-.'", "    ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


# Descriptor -> synonyms used for it in store listings.
DESCRIPTOR_SYNONYMS = {
    "Original": ["Classic", "Regular"],
    "Organic": ["Natural", "Pure"],
    "Family Pack": ["Value Pack", "Large Pack"],
    "Heavy Duty": ["Strong", "Powerful"],
    "Portable": ["Lightweight"],
    "Compact": ["Mini", "Small"],
    "Eco-Friendly": ["Green", "Sustainable"],
    "Gluten-Free": ["Wheat-Free", "Celiac-Friendly"],
    "Low Sugar": ["Reduced Sugar", "Sugar-Free"],
}


def map_tokens(tokens: Column, mapping: dict[str, str]) -> Column:
    """Replace each array element found in ``mapping`` (literal map lookup)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.transform(tokens, lambda w: F.coalesce(F.element_at(m, w), w))


def canonical_descriptors(text: Column, synonyms: dict[str, list[str]] | None = None) -> Column:
    """replace descriptor synonyms (longest phrases first) by the
    original descriptor, case-insensitive, on word boundaries."""
    syn = synonyms or DESCRIPTOR_SYNONYMS
    pairs = sorted(((s, o) for o, ss in syn.items() for s in ss), key=lambda p: -len(p[0]))
    t = text
    for s, o in pairs:
        t = F.regexp_replace(t, r"(?i)\b" + s.replace(" ", r"\s+") + r"\b", o)
    return t


def scraped_name_normalise(name: Column, brand: Column | None = None,
                           patterns: list[str] | None = None) -> Column:
    """drop the brand mention and noise patterns, fold case, and sort
    the distinct tokens, so differently written names compare equal."""
    t = F.lower(name)
    if brand is not None:
        t = F.when(brand.isNotNull(), F.replace(t, F.lower(brand), F.lit(""))).otherwise(t)
    for p in patterns or [r"\(.*?\)", r"[^\w\s]"]:
        t = F.regexp_replace(t, "(?U)" + p, " ")
    toks = F.filter(F.split(F.trim(t), r"\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(F.array_distinct(toks)), " ")


def product_name(*parts: Column) -> Column:
    """non-empty parts joined with single spaces."""
    return F.concat_ws(" ", *[F.nullif(F.trim(p.cast("string")), F.lit("")) for p in parts])


def rating_sentiment(rating: Column) -> Column:
    """4-5 positive, 3 neutral, 1-2 negative."""
    return (F.when(rating >= 4, "positive").when(rating == 3, "neutral")
            .when(rating.isin(1, 2), "negative"))


# Standard word -> texting shorthand.
TEXTING_SHORTHAND = {
    "you": "u",
    "are": "r",
    "please": "pls",
    "people": "ppl",
    "message": "msg",
    "before": "b4",
    "with": "w",
    "really": "rly",
    "thanks": "thx",
    "okay": "ok",
    "see": "c",
    "about": "abt",
    "today": "tdy",
    "very": "v",
    "great": "gr8",
    "love": "luv",
}

# Standard word -> typo variants.
TYPO_POOL = {
    "the": ["teh", "th", "the"],
    "and": ["adn", "nd"],
    "good": ["goood", "goof"],
    "great": ["graet", "greta"],
    "product": ["prodcut", "prdouct"],
    "quality": ["quailty", "qualiy"],
    "would": ["woud", "wuold"],
}


def default_folds() -> dict[str, str]:
    """Inverse of the shorthand and typo tables: variant -> standard word."""
    folds = {v: k for k, v in TEXTING_SHORTHAND.items()}
    for k, vs in TYPO_POOL.items():
        for v in vs:
            folds[v] = k
    return folds


def typo_fold(text: Column, folds: dict[str, str] | None = None) -> Column:
    """fold shorthand tokens to their standard word; punctuation and
    spacing between tokens are kept (tokens split on single spaces)."""
    m = folds or default_folds()
    toks = F.split(text, " ")
    mp = F.create_map(*[F.lit(x) for kv in m.items() for x in kv])

    def fold(w):
        core = F.regexp_extract(w, r"^(.*?)([.,!?;:]*)$", 1)
        tail = F.regexp_extract(w, r"^(.*?)([.,!?;:]*)$", 2)
        rep = F.element_at(mp, F.lower(core))
        return F.when(rep.isNotNull(), F.concat(rep, tail)).otherwise(w)

    return F.array_join(F.transform(toks, fold), " ")


# How scraped listings write brand and product.
NAME_PATTERNS = [
    "{brand} {product}",
    "{product}",
    "{product} - {brand}",
    "{brand} - {product}",
    "{product} ({brand})",
    "{brand} ({product})",
    "{product} | {brand}",
    "[{brand}] {product}",
    "{product} [{brand}]",
]


def render_name_pattern(index: Column, brand: Column, product: Column) -> Column:
    """Listing name in the ``index``-th pattern (input for F39)."""
    expr = None
    for i, p in enumerate(NAME_PATTERNS):
        pre, rest = p.split("{", 1)[0], p
        parts = []
        for tok in rest.replace("}", "{").split("{"):
            if tok == "brand":
                parts.append(brand)
            elif tok == "product":
                parts.append(product)
            elif tok:
                parts.append(F.lit(tok))
        v = F.concat(*parts)
        expr = F.when(index == i, v) if expr is None else expr.when(index == i, v)
    return expr
