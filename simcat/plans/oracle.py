"""DuckDB SQL text for the oracle: the same derivation and parsers written in SQL.

These strings are the independent check of the Spark operators: the driver runs
them in DuckDB on the same parquet tables and compares results.  Each helper
returns a SQL expression over an input expression ``x``.
"""

from __future__ import annotations

# Fixed values, written out here once more: the SQL must not share constants with the code it checks.
MISSING_TOKENS = ["", "nan", "none", "null", "<na>", "n/a"]
WEIGHT_UNITS = {
    "g": 1.0, "gram": 1.0, "grams": 1.0, "gm": 1.0, "gms": 1.0,
    "kg": 1000.0, "kilogram": 1000.0, "kilograms": 1000.0,
    "mg": 0.001, "milligram": 0.001,
    "oz": 28.3495, "ounce": 28.3495, "ounces": 28.3495,
    "lb": 453.592, "lbs": 453.592, "pound": 453.592, "pounds": 453.592,
}
WEIGHT_UNITS_LENIENT = {u: f for u, f in WEIGHT_UNITS.items() if u not in ("gm", "gms")}
NUMBER_PATTERN = r"[\d,]+\.?\d*"
WEIGHT_PATTERN = r"([\d.,]+)\s*([a-zA-Z]+)"
RATING_PATTERN = r"([\d.]+)\s*out of\s*5"
SENTINEL_PATTERN = r"^9{6,}(\.0+)?$"
FLOAT_TEXT_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TOKEN_PATTERN = r"\b\w\w+\b"
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's",
    "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't",
    "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot",
    "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's",
    "where's", "who's", "why's", "would",
]
# The parts of two or more letters that the contractions above are cut into.
STOP_PARTS = ["ll", "ve", "re", "isn", "aren", "wasn", "weren", "haven", "hasn", "hadn", "doesn",
              "didn", "won", "wouldn", "shan", "shouldn", "mustn", "couldn", "let"]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def is_missing(x: str) -> str:
    toks = ", ".join(q(t) for t in MISSING_TOKENS)
    return f"({x} IS NULL OR lower({strip(x)}) IN ({toks}))"


def float_text(s: str) -> str:
    return f"(CASE WHEN regexp_matches({s}, {q(FLOAT_TEXT_PATTERN)}) THEN TRY_CAST({s} AS DOUBLE) END)"


def parse_price(x: str, lenient: bool = False) -> str:
    nums = (f"list_filter(list_transform(regexp_extract_all({x}, {q(NUMBER_PATTERN)}, 0), "
            f"lambda m: TRY_CAST(replace(m, ',', '') AS DOUBLE)), lambda v: v IS NOT NULL)")
    value = f"(CASE WHEN len({nums}) > 0 THEN list_sum({nums}) / len({nums}) END)"
    if lenient:
        return f"(CASE WHEN {x} IS NOT NULL THEN {value} END)"
    return f"(CASE WHEN NOT {is_missing(x)} AND {value} > 0 THEN {value} END)"


def _unit_case(unit: str, units: dict) -> str:
    whens = " ".join(f"WHEN {q(u)} THEN CAST({f!r} AS DOUBLE)" for u, f in units.items())
    return f"(CASE {unit} {whens} END)"


def parse_weight(x: str, sentinel: float = 1_000_000.0, lenient: bool = False) -> str:
    low = f"lower({x})"
    found = f"regexp_matches({low}, {q(WEIGHT_PATTERN)})"
    qty = float_text(f"replace(regexp_extract({low}, {q(WEIGHT_PATTERN)}, 1), ',', '')")
    unit = f"regexp_extract({low}, {q(WEIGHT_PATTERN)}, 2)"
    grams = f"({qty} * {_unit_case(unit, WEIGHT_UNITS_LENIENT if lenient else WEIGHT_UNITS)})"
    if lenient:
        return f"(CASE WHEN {x} IS NOT NULL AND {found} THEN {grams} END)"
    return (f"(CASE WHEN NOT {is_missing(x)} AND {found} AND {grams} > 0 "
            f"AND {grams} < CAST({sentinel!r} AS DOUBLE) THEN {grams} END)")


def parse_rating(x: str, lenient: bool = False) -> str:
    matched = f"regexp_matches({x}, {q(RATING_PATTERN)})"
    prose = float_text(f"regexp_extract({x}, {q(RATING_PATTERN)}, 1)")
    plain = float_text(strip(x))

    def in_range(v):
        return f"(CASE WHEN {v} >= 0 AND {v} <= 5 THEN {v} END)"
    if lenient:
        return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {matched} THEN {prose} "
                f"ELSE {in_range(plain)} END)")
    return (f"(CASE WHEN NOT {is_missing(x)} THEN "
            f"{in_range(f'(CASE WHEN {matched} THEN {prose} ELSE {plain} END)')} END)")


def parse_percentage(x: str) -> str:
    v = float_text(f"regexp_replace({x}, '[^\\d.]', '', 'g')")
    return f"(CASE WHEN NOT {is_missing(x)} AND {v} >= 0 AND {v} <= 100 THEN {v} END)"


def parse_dict(x: str) -> str:
    j = f"replace({x}, chr(39), chr(34))"
    return (f"(CASE WHEN NOT {is_missing(x)} AND json_valid({j}) AND json_type({j}) = 'OBJECT' "
            f"THEN CAST(CAST({j} AS JSON) AS MAP(VARCHAR, VARCHAR)) END)")


def category_key(x: str) -> str:
    keys = f"list_filter(map_keys({parse_dict(x)}), lambda k: {strip('k')} <> '')"
    return strip(f"({keys})[-1]")


def category_rank(x: str) -> str:
    last = f"(map_values({parse_dict(x)}))[-1]"
    digits = f"regexp_replace(coalesce({last}, ''), '[^\\d]', '', 'g')"
    return f"(CASE WHEN {digits} <> '' THEN TRY_CAST({digits} AS DOUBLE) END)"


def split_multi(x: str) -> str:
    parts = (f"list_filter(list_transform(string_split({x}, '|'), lambda p: lower({strip('p')})), "
             f"lambda p: p <> '')")
    return f"(CASE WHEN {is_missing(x)} THEN []::VARCHAR[] ELSE {parts} END)"


def first_of_multi(x: str) -> str:
    return f"({split_multi(x)})[1]"


def clean_text(x: str) -> str:
    s = f"lower({x})"
    s = f"regexp_replace({s}, 'https?://\\S+', ' ', 'g')"
    s = f"regexp_replace({s}, '[^a-z0-9\\s]', ' ', 'g')"
    s = strip(f"regexp_replace({s}, '\\s+', ' ', 'g')")
    return f"(CASE WHEN {is_missing(x)} THEN '' ELSE {s} END)"


def clean_categorical(x: str) -> str:
    s = f"lower({strip(x)})"
    return f"(CASE WHEN NOT {is_missing(x)} AND {s} <> '' THEN {s} END)"


def list_price(price: str, disc: str) -> str:
    return (f"(CASE WHEN {price} IS NOT NULL AND {disc} IS NOT NULL AND {disc} < 100 "
            f"THEN {price} / (1.0::DOUBLE - {disc} / 100.0::DOUBLE) END)")


def text_concat(name: str, kw: str) -> str:
    return strip(f"({clean_text(name)} || ' ' || {clean_text(kw)})")


def yn_flag(x: str) -> str:
    return f"coalesce(CAST(upper({strip(x)}) = 'Y' AS DOUBLE), 0.0::DOUBLE)"


def to_number(x: str) -> str:
    return float_text(strip(x))


def review_count(x: str) -> str:
    d = f"regexp_replace(CAST({x} AS VARCHAR), '[^\\d]', '', 'g')"
    return f"(CASE WHEN {d} <> '' THEN TRY_CAST({d} AS DOUBLE) END)"


def is_sentinel(x: str) -> str:
    return f"coalesce(regexp_matches(lower({strip(x)}), {q(SENTINEL_PATTERN)}), false)"


def tokens(x: str) -> str:
    stop = "[" + ", ".join(q(w) for w in STOP_WORDS + STOP_PARTS) + "]"
    words = f"regexp_extract_all(lower(coalesce({x}, '')), {q(TOKEN_PATTERN)}, 0)"
    return f"list_filter({words}, lambda w: NOT list_contains({stop}, w))"


def ngrams_of(t: str) -> str:
    """Unigrams then bigrams of an already tokenised list column ``t``."""
    return (f"list_concat({t}, list_transform(range(1, len({t})), "
            f"lambda i: {t}[i] || ' ' || {t}[i + 1]))")


def word_count(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN {s} = '' THEN 0 ELSE len(regexp_split_to_array({s}, '\\s+')) END)"


# --------------------------------------------------------------------------
# Views
# --------------------------------------------------------------------------

def _catalog_select(name_sql: str) -> str:
    k = "p_partkey"
    price = "CAST(p_retailprice AS DECIMAL(12,2))"
    price_txt = f"CAST({price} AS VARCHAR)"
    price5_txt = f"CAST(CAST({price} + 5 AS DECIMAL(12,2)) AS VARCHAR)"
    k3 = f"lpad(CAST({k} % 1000 AS VARCHAR), 3, '0')"
    qt = "chr(39)"
    return f"""SELECT {k} AS src_seq, CAST({k} AS VARCHAR) AS uniq_id,
  {name_sql} AS product_name,
  CASE WHEN {k} % 4 = 0 THEN NULL WHEN {k} % 29 = 0 THEN ' N/A ' ELSE ' ' || p_brand END AS brand,
  CASE WHEN {k} % 5 = 0 THEN split_part(p_name, ' ', 1) ||
       CASE WHEN {k} % 2 = 0 THEN '|Black| ' ELSE '|White|Black' END END AS colour,
  CASE WHEN {k} % 11 = 0 THEN NULL
       WHEN {k} % 13 = 0 THEN '$' || {price_txt} || ' - $' || {price5_txt}
       WHEN {k} % 7 = 0 THEN '1,' || {k3} || '.00'
       ELSE {price_txt} END AS sales_price,
  CASE WHEN {k} % 20 = 0 THEN CAST(p_size AS VARCHAR) || ' g' WHEN {k} % 20 = 5 THEN '1.5 kg'
       WHEN {k} % 20 = 10 THEN '3.2 ounces' WHEN {k} % 20 = 15 THEN '500'
       ELSE '999999999' END AS weight,
  CASE WHEN {k} % 41 = 0 THEN '11.0'
       WHEN {k} % 3 = 0 THEN CAST({k} % 5 AS VARCHAR) || '.5 out of 5 stars'
       ELSE CAST({k} % 5 + 1 AS VARCHAR) || '.0' END AS rating,
  CASE WHEN {k} % 8 = 0 THEN NULL WHEN {k} % 19 = 0 THEN '150'
       WHEN {k} % 2 = 0 THEN CAST(({k} % 9) * 10 AS VARCHAR) || '%'
       ELSE CAST(({k} % 9) * 10 AS VARCHAR) END AS discount_percentage,
  CASE WHEN {k} % 50 = 3 THEN NULL ELSE p_type END AS browsenode,
  CASE WHEN {k} % 10 = 0 THEN NULL ELSE p_type || ' ' || p_name END AS meta_keywords,
  'https://Img.example/' || CAST({k} AS VARCHAR) || '.jpg|https://Img.example/b.jpg' AS medium,
  CASE WHEN {k} % 6 = 0 THEN NULL WHEN {k} % 61 = 0 THEN 'not a dict'
       ELSE '{{' || {qt} || 'Cat' || CAST({k} % 12 AS VARCHAR) || {qt} || ': ' || {qt} || '#1,'
            || {k3} || {qt} || '}}' END AS sales_rank_in_child_category,
  CASE WHEN {k} % 9 = 0 THEN NULL
       ELSE '{{' || {qt} || 'Top' || {qt} || ': ' || {qt} || '#19,259' || {qt} || ', ' || {qt}
            || 'Par' || CAST({k} % 3 AS VARCHAR) || {qt} || ': ' || {qt} || '#12' || {qt} || '}}'
       END AS sales_rank_in_parent_category,
  CASE WHEN {k} % 4 = 1 THEN ' y ' WHEN {k} % 4 = 2 THEN NULL ELSE 'N' END AS amazon_prime__y_or_n,
  CASE WHEN {k} % 25 = 0 THEN 'Y' ELSE 'N' END AS best_seller_tag__y_or_n,
  CASE WHEN {k} % 9 = 0 THEN CAST({k} % 300 AS VARCHAR) || ' ratings' END AS no__of_reviews,
  CASE WHEN {k} % 33 <> 0 THEN 'A' || CAST({k} // 2 AS VARCHAR) END AS asin,
  CASE WHEN {k} % 3 <> 0 THEN 'https://Img.example/s/' || CAST({k} AS VARCHAR) || '.jpg' END
    AS image_urls__small,
  CASE WHEN {k} % 4 = 1 THEN '  ' ELSE 'https://Img.example/l/' || CAST({k} AS VARCHAR) END AS large,
  CASE WHEN {k} % 7 <> 0 THEN p_type || ' > ' || p_brand END AS parent___child_category__all,
  CASE WHEN {k} % 5 <> 1 THEN '{{' || {qt} || 'Size' || {qt} || ': ' || {qt} || CAST(p_size AS VARCHAR)
       || {qt} || ', ' || {qt} || 'Kind' || {qt} || ': ' || {qt} || p_type || {qt} || '}}' END
    AS product_details__k_v_pairs
FROM part"""


RAW_TEXT_COLUMNS = [
    "product_name", "brand", "colour", "sales_price", "weight", "rating", "discount_percentage",
    "browsenode", "meta_keywords", "medium", "sales_rank_in_child_category",
    "sales_rank_in_parent_category", "amazon_prime__y_or_n", "best_seller_tag__y_or_n",
    "no__of_reviews", "asin", "image_urls__small", "large", "parent___child_category__all",
    "product_details__k_v_pairs"]


def catalog_raw_sql() -> str:
    name = ("CASE WHEN p_partkey % 17 = 0 THEN p_name || ' https://x.example/' || "
            "CAST(p_partkey AS VARCHAR) ELSE p_name || ' ' || p_type END")
    place = lambda sql, n: sql.replace("SELECT p_partkey AS src_seq",
                                       f"SELECT p_partkey * 3 + {n} AS src_seq", 1)
    bare = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in RAW_TEXT_COLUMNS)
    return (f"{place(_catalog_select(name), 0)}\nUNION ALL\n"
            f"{place(_catalog_select("p_name || ' copy'"), 1)} WHERE p_partkey % 50 = 0\nUNION ALL\n"
            "SELECT p_partkey * 3 + 2 AS src_seq, CASE WHEN p_partkey % 120 = 0 THEN NULL "
            "WHEN p_partkey % 80 = 0 THEN '   ' ELSE 'bare' || CAST(p_partkey AS VARCHAR) END AS uniq_id, "
            f"{bare} FROM part WHERE p_partkey % 40 = 0")


def cleaned_sql(src: str = "catalog_raw", sentinel: float = 1_000_000.0) -> str:
    """Typed columns before id filter and dedup."""
    price = parse_price("sales_price")
    disc = parse_percentage("discount_percentage")
    return f"""SELECT {strip('uniq_id')} AS product_id,
  coalesce(product_name, '') AS product_name,
  {clean_categorical('brand')} AS brand,
  {price} AS sales_price,
  {parse_rating('rating')} AS rating,
  {disc} AS discount_percentage,
  {clean_categorical('browsenode')} AS browsenode,
  {parse_weight('weight', sentinel)} AS weight_grams,
  {category_rank('sales_rank_in_child_category')} AS sales_rank,
  {list_price(price, disc)} AS list_price,
  {category_key('sales_rank_in_child_category')} AS child_category,
  {category_key('sales_rank_in_parent_category')} AS parent_category,
  {split_multi('colour')} AS colour_tokens,
  {text_concat('product_name', 'meta_keywords')} AS text,
  {yn_flag('amazon_prime__y_or_n')} AS is_prime,
  {yn_flag('best_seller_tag__y_or_n')} AS is_best_seller,
  {first_of_multi('medium')} AS image_url,
  src_seq
FROM {src}"""


def products_sql(src: str = "catalog_raw") -> str:
    return f"""SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY src_seq) AS _rn
  FROM ({cleaned_sql(src)}) c
  WHERE product_id IS NOT NULL AND product_id <> '') d
WHERE _rn = 1"""


def with_views(body: str, *views: tuple[str, str]) -> str:
    """Prefix ``WITH`` views; ``catalog_raw`` and ``products`` are always available."""
    base = [("catalog_raw", catalog_raw_sql()), ("products", products_sql())]
    allv = base + list(views)
    ctes = ",\n".join(f"{n} AS (\n{s}\n)" for n, s in allv)
    return f"WITH {ctes}\n{body}"


# --------------------------------------------------------------------------
# Feature pipeline (raw TF-IDF text block)
# --------------------------------------------------------------------------

NUMERIC = [("sales_price", True), ("list_price", True), ("rating", False),
           ("discount_percentage", False), ("weight_grams", True), ("sales_rank", True)]
BLOCK_NAMES = ["category", "text", "numeric", "brand", "colour"]


def _log(x: str, use_log: bool) -> str:
    return f"(CASE WHEN {x} IS NOT NULL THEN ln(1.0::DOUBLE + greatest({x}, 0.0::DOUBLE)) END)" \
        if use_log else f"CAST({x} AS DOUBLE)"


def feature_views(weights: dict, top_brands: int = 300, top_colours: int = 60,
                  min_df: int = 3, max_features: int = 4096) -> list[tuple[str, str]]:
    total = sum(weights.get(b, 0.0) for b in BLOCK_NAMES)
    w = {b: float(weights.get(b, 0.0)) / total for b in BLOCK_NAMES}
    xs = ", ".join(f"{_log(n, lg)} AS x{i}" for i, (n, lg) in enumerate(NUMERIC))
    logged = f"SELECT product_id, {xs}, is_prime, is_best_seller FROM products"
    meds = ", ".join(f"coalesce(median(x{i}), 0.0::DOUBLE) AS med{i}" for i in range(6))
    mom = ", ".join(f"avg(coalesce(x{i}, med{i})) AS mean{i}, "
                    f"CASE WHEN stddev_pop(coalesce(x{i}, med{i})) > 1e-12 THEN "
                    f"stddev_pop(coalesce(x{i}, med{i})) ELSE 1.0::DOUBLE END AS sc{i}"
                    for i in range(6))
    nstats = f"SELECT * FROM (SELECT {meds} FROM logged) m, LATERAL (SELECT {mom} FROM logged) s"
    comps = ([f"(coalesce(x{i}, med{i}) - mean{i}) / sc{i}" for i in range(6)]
             + [f"CAST(x{i} IS NULL AS DOUBLE)" for i in range(6)]
             + ["coalesce(is_prime, 0.0::DOUBLE)", "coalesce(is_best_seller, 0.0::DOUBLE)"])
    allmiss = " AND ".join(f"x{i} IS NULL" for i in range(6))
    numraw = (f"SELECT product_id, [{', '.join(comps)}] AS v, NOT ({allmiss}) AS has_numeric "
              f"FROM logged, nstats")
    numv = ("SELECT product_id, has_numeric, CASE WHEN nrm = 0 THEN v ELSE "
            "list_transform(v, lambda e: e / nrm) END AS num_vec FROM "
            "(SELECT *, sqrt(list_sum(list_transform(v, lambda e: e * e))) AS nrm FROM numraw) t")
    brands = (f"SELECT brand, count(*) AS n FROM products WHERE brand IS NOT NULL AND brand <> '' "
              f"GROUP BY brand ORDER BY n DESC, brand ASC LIMIT {top_brands}")
    colours = (f"SELECT token, count(*) AS n FROM (SELECT unnest(colour_tokens) AS token FROM products) u "
               f"GROUP BY token ORDER BY n DESC, token ASC LIMIT {top_colours}")
    tf = (f"SELECT product_id, term, count(*) AS tf FROM (SELECT product_id, unnest({ngrams_of('t')}) AS term "
          f"FROM (SELECT product_id, {tokens('text')} AS t FROM products) a) b GROUP BY product_id, term")
    vocab = (f"SELECT term, df, cf, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf FROM "
             f"(SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term HAVING count(*) >= {min_df} "
             f"ORDER BY cf DESC, term ASC LIMIT {max_features}) v, (SELECT count(*) AS n FROM products) c")
    tfidf = ("SELECT product_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY product_id)) AS w FROM "
             "(SELECT tf.product_id, tf.term, (1.0::DOUBLE + ln(tf.tf)) * vocab.idf AS raw "
             "FROM tf JOIN vocab USING (term)) r")
    cat = ("list_filter(['browsenode=' || browsenode, 'child_category=' || child_category, "
           "'parent_category=' || parent_category], lambda t: t IS NOT NULL)")
    base = f"""SELECT p.product_id, p.product_name, p.brand, p.child_category, p.sales_price, p.rating,
  p.image_url, {cat} AS cat_tokens, n.num_vec, n.has_numeric,
  CASE WHEN p.brand IN (SELECT brand FROM brands) THEN p.brand END AS brand_top,
  list_sort(list_distinct(list_filter(p.colour_tokens, lambda t: list_contains(cv.cv, t))))
    AS colour_top,
  coalesce((SELECT count(*) FROM tfidf WHERE tfidf.product_id = p.product_id), 0) > 0 AS has_text
FROM products p JOIN numv n USING (product_id),
  (SELECT coalesce(list(token), []::VARCHAR[]) AS cv FROM colours) cv"""
    has = (f"SELECT *, len(cat_tokens) > 0 AS has_category, brand_top IS NOT NULL AS has_brand, "
           f"len(colour_top) > 0 AS has_colour FROM base")
    avail = " + ".join(f"CAST(has_{b} AS DOUBLE) * {w[b]!r}" for b in BLOCK_NAMES)
    effs = ", ".join(f"CASE WHEN avail > 0 THEN CAST(has_{b} AS DOUBLE) * {w[b]!r} / avail "
                     f"ELSE 0.0::DOUBLE END AS eff_{b}" for b in BLOCK_NAMES)
    feats = f"SELECT *, {effs} FROM (SELECT *, {avail} AS avail FROM has) h"
    return [("logged", logged), ("nstats", nstats), ("numraw", numraw), ("numv", numv),
            ("brands", brands), ("colours", colours), ("tf", tf), ("vocab", vocab),
            ("tfidf", tfidf), ("base", base), ("has", has), ("feats", feats)]


def pair_score_sql(a: str = "a", b: str = "b") -> str:
    """Closed-form score of two rows of ``feats`` (text cosine from column ``tc``)."""
    def cos_set(col):
        return (f"(CASE WHEN len({a}.{col}) = 0 OR len({b}.{col}) = 0 THEN 0.0::DOUBLE ELSE "
                f"len(list_intersect({a}.{col}, {b}.{col})) / sqrt(len({a}.{col}) * len({b}.{col})) END)")
    return (f"(sqrt({a}.eff_category * {b}.eff_category) * {cos_set('cat_tokens')}"
            f" + sqrt({a}.eff_text * {b}.eff_text) * coalesce(tc, 0.0::DOUBLE)"
            f" + sqrt({a}.eff_numeric * {b}.eff_numeric) * list_inner_product({a}.num_vec, {b}.num_vec)"
            f" + sqrt({a}.eff_brand * {b}.eff_brand) * (CASE WHEN {a}.brand_top = {b}.brand_top"
            f" THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
            f" + sqrt({a}.eff_colour * {b}.eff_colour) * {cos_set('colour_top')})")


def topk_sql(queries_sql: str, k: int, weights: dict, rating: str = "rating", cands: str = "feats",
             more: list = (), **fv) -> str:
    """Top-k by the closed-form score for the ids returned by ``queries_sql``.

    ``cands`` is the candidates' view (made by ``more``), whose column ``rating`` breaks ties.
    """
    shown = "" if rating == "rating" else f", b.{rating}"
    body = f"""SELECT query_id, CAST(rank AS BIGINT) AS rank, product_id, score, product_name, brand,
  child_category, sales_price, rating, image_url{shown.replace("b.", "")} FROM (
  SELECT a.product_id AS query_id, b.product_id, round({pair_score_sql()}, 6) AS score,
    b.product_name, b.brand, b.child_category, b.sales_price, b.rating, b.image_url{shown},
    row_number() OVER (PARTITION BY a.product_id ORDER BY round({pair_score_sql()}, 6) DESC,
      coalesce(b.{rating}, -1.0::DOUBLE) DESC, coalesce(b.sales_price, 'inf'::DOUBLE) ASC,
      b.product_id ASC) AS rank
  FROM (SELECT * FROM feats WHERE product_id IN ({queries_sql})) a
  JOIN {cands} b ON a.product_id <> b.product_id
  LEFT JOIN (SELECT x.product_id AS qa, y.product_id AS qb, sum(x.w * y.w) AS tc
             FROM tfidf x JOIN tfidf y ON x.term = y.term
             WHERE x.product_id IN ({queries_sql}) GROUP BY 1, 2) t
    ON t.qa = a.product_id AND t.qb = b.product_id) r
WHERE rank <= {k}"""
    return with_views(body, *feature_views(weights, **fv), *more)
