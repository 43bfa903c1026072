"""Shared SQL fragments for the DuckDB side (RE2: no lookahead, ASCII \\s)."""

SPACE = r"[\s\x{0B}\x{85}\p{Z}]"
GPT2_MARK = rf"({SPACE}+)({SPACE}[^\s\x{{0B}}\x{{85}}\p{{Z}}])"
GPT2_RE = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\x{0B}\x{85}\p{Z}\p{L}\p{N}\x01]+|"
    r"[\s\x{0B}\x{85}\p{Z}]+"
)
INLINE = r"[\t\f \x{0B}\x{85}\p{Z}]"
GPT4_MARK = rf"({SPACE}+)({INLINE}[^\s\x{{0B}}\x{{85}}\p{{Z}}])"
GPT4_RE = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}\x01]?\p{L}+|\p{N}{1,3}|"
    r" ?[^\s\x{0B}\x{85}\p{Z}\p{L}\p{N}\x01]+[\r\n]*|[\s\x{0B}\x{85}\p{Z}]*[\r\n]|"
    r"[\s\x{0B}\x{85}\p{Z}]+"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def gpt2_pieces(column: str) -> str:
    marked = f"regexp_replace({column}, {quoted(GPT2_MARK)}, '\\1' || chr(1) || '\\2', 'g')"
    return f"regexp_extract_all({marked}, {quoted(GPT2_RE)})"


def gpt4_pieces(column: str) -> str:
    marked = f"regexp_replace({column}, {quoted(GPT4_MARK)}, '\\1' || chr(1) || '\\2', 'g')"
    return f"regexp_extract_all({marked}, {quoted(GPT4_RE)})"


def words(column: str) -> str:
    return (
        f"list_filter(regexp_split_to_array({column}, "
        r"'[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+'), lambda w: w <> '')"
    )


def byte_symbols(column: str) -> str:
    """Bytes of a text as one character each, 0..255."""
    return (
        f"list_aggregate(list_transform(range(0, octet_length(encode({column}))), "
        f"lambda i: chr(('0x' || substr(hex(encode({column})), 2 * i + 1, 2))::INTEGER)), "
        "'string_agg', '')"
    )


SPECIALS = {"<|endoftext|>": 1000, "<|endoftext|><|endoftext|>": 1001}
SPECIAL_RE = r"<\|endoftext\|><\|endoftext\|>|<\|endoftext\|>"
# Documents with special tokens planted at sentence ends, doubled at line ends.
PLANTED = (
    "replace(replace(text, '.' || chr(10), '<|endoftext|><|endoftext|>'), '. ', ' <|endoftext|> ')"
)


def hex_symbols(hex_column: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({hex_column}, '..'), "
        "lambda h: chr(('0x' || h)::INTEGER)), '')"
    )


def merge_ctes(sequences: str, merges: int, tie: str = "bytes") -> str:
    """Unrolled merge learning. ``sequences`` selects (piece, sym, n); ends with table ``w{merges}``."""
    order = "h.hex DESC, g.hex DESC" if tie == "bytes" else "unicode(l), unicode(r)"
    out = [f"w0 AS MATERIALIZED ({sequences})"]
    out.append(
        "v0 AS MATERIALIZED (SELECT chr(i::INTEGER) AS sym, lpad(hex(i), 2, '0') AS hex "
        "FROM range(0, 256) t(i))"
    )
    for k in range(merges):
        out.append(
            f"p{k} AS MATERIALIZED (SELECT l, r, sum(n) AS cnt FROM (SELECT n, unnest(a[1:len(a)-1]) AS l, "
            f"unnest(a[2:len(a)]) AS r FROM (SELECT n, string_split(sym, '') AS a FROM w{k} WHERE length(sym) > 1)) "
            "GROUP BY l, r)"
        )
        out.append(
            f"b{k} AS MATERIALIZED (SELECT l, r, cnt, h.hex AS lh, g.hex AS rh FROM p{k} "
            f"JOIN v{k} h ON h.sym = l JOIN v{k} g ON g.sym = r ORDER BY cnt DESC, {order} LIMIT 1)"
        )
        out.append(
            f"v{k + 1} AS MATERIALIZED (SELECT * FROM v{k} UNION ALL SELECT chr({256 + k}), lh || rh FROM b{k})"
        )
        out.append(
            f"w{k + 1} AS MATERIALIZED (SELECT piece, replace(sym, (SELECT l || r FROM b{k}), chr({256 + k})) AS sym, n "
            f"FROM w{k})"
        )
    return ",\n".join(out)


def merge_list(merges: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {k} AS rank, unicode(l)::INTEGER AS \"left\", unicode(r)::INTEGER AS \"right\", "
        f"{256 + k} AS new_id, lh, rh, cnt FROM b{k}"
        for k in range(merges)
    )


def apply_merges(sym: str, merges: int) -> str:
    """The symbols of other pieces after the merges that ``merge_ctes`` learned, in order."""
    for k in range(merges):
        sym = f"replace({sym}, (SELECT l || r FROM b{k}), chr({256 + k}))"
    return sym


PIECE_SEQUENCES = (
    f"SELECT piece, {hex_symbols('hex(encode(piece))')} AS sym, count(*) AS n "
    f"FROM (SELECT unnest({gpt2_pieces('text')}) AS piece FROM documents) GROUP BY piece"
)
DOC_SEQUENCES = (
    f"SELECT doc_id AS piece, {hex_symbols('hex(encode(text))')} AS sym, 1 AS n FROM documents"
)
