"""Statement reconstruction from positioned words, as Spark jobs.

Input is a words table ``(source_file, page, text, x0, x1, top)`` (one row per
word as a PDF text extractor emits it) and, for page-level facts, a pages
table ``(source_file, page, text)``.  All state is per (file, page): a page's
words are gathered once and cut into lines where the rounded ``top`` changes,
its lines are cut into transactions at date lines, and each transaction is
folded from its own few lines.  Groups are therefore bounded by a page, never
by a file or an owner, and nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The statement layout this parser reads.
AMOUNT_RE = r"^\d{1,3}(,\d{3})*\.\d{2}$"
NOISE_FRAGMENTS = (
    "Page ", "United Overseas", "Please note", "please note", "Pleasenote",
    "请注意", "omissions", "claim against", "Co. Reg", "GST Reg",
    "----------", "------------------------",
)
SAVINGS_NOISE = NOISE_FRAGMENTS + (
    "Date", "Withdrawals", "Deposits", "Balance SGD",
    "End of", "continued", "Account Transaction Details", "One Account 761",
    "Total ",
)
CARD_NOISE = NOISE_FRAGMENTS + (
    "Post", "Trans", "Date", "Description of Transaction", "Transaction Amount",
    "UOB ONE CARD", "continued", "End of Transaction",
    "SUB TOTAL", "TOTAL BALANCE",
)
SAVINGS_DATE_RE = r"^\d{1,2}\s+(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)$"
CARD_DATE_RE = r"^\d{1,2}\s+(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)$"
DEPOSIT_KEYWORDS = ("Inward Credit", "Interest Credit", "Credit")
SAVINGS_SKIP = ("BALANCE B/F", "Total", "Interest Credit")
CARD_SKIP = ("PREVIOUS BALANCE", "SUB TOTAL", "TOTAL BALANCE FOR UOB ONE CARD")
SAVINGS_REF_RE = r"^(xxxxxx\d*|PIB\d+|\d{7,}|OTHR|SGD)$"
CARD_REF_RE = r"^Ref No\."
CARD_HEADERS = ("Description of Transaction", "Transaction Amount")
SAVINGS_YEAR_RE = r"Period:.*?(\d{4})"
CARD_YEAR_RE = r"Statement Date\s+\d{1,2}\s+\w+\s+(\d{4})"
SAVINGS_DEFAULT_YEAR, CARD_DEFAULT_YEAR = "2025", "2026"
CLOSING_RE = r"(?m)One Account\s+SGD[\d\s.,-]+?([\d,]+\.\d{2})\s*$"
GRAND_TOTAL_RE = r"Grand Total.*?([\d,]+\.\d{2})"
COLUMNS = ("withdrawal", "deposit", "balance")
COLUMN_HEADERS = ("Withdrawals", "Deposits", "Balance")

PAGE = ("source_file", "page")


def _contains_any(c: Column, fragments: Sequence[str]) -> Column:
    cond = F.lit(False)
    for f in fragments:
        cond = cond | c.contains(f)
    return cond


def _amount_value(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").cast("decimal(18,2)")


def _bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once, however often ``fn`` uses it (also inside lambdas).

    A fold over no elements hands its start to the last step as it is; a transform would copy the result, with all that it holds."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, fn)


def _cut(rows: Column, starts: Column, fn: Callable[[Column, Column], Column]) -> Column:
    """``fn(piece, number)`` of each piece of ``rows``: from a start (places from 0, ascending) up to the next, numbered from 0.

    A slice would go through all of ``rows`` for each piece."""
    def piece(s, i):
        return F.transform(F.sequence(s, F.coalesce(F.get(starts, i + 1), F.size(rows)) - 1), lambda at: F.get(rows, at))

    return F.transform(starts, lambda s, i: fn(piece(s, i), i))


# ----------------------------------------------------------------- R1, R2

def page_lines(words: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """One row per page: its lines (array<struct<top, text, words>>) in ``top`` order, as in :func:`words_to_lines`.

    A page's words are gathered (before the shuffle those of a split), sorted once and then
    cut where ``top`` changes, so a page is one group, not one for each of its lines.
    """
    word = F.struct(F.round("top", 1).alias("top"), "x0", "x1", "text")
    pages = words.select(*keys, word.alias("w")).groupBy(*keys).agg(F.collect_list("w").alias("ws"))

    def line(ws, _):
        return F.struct(ws[0]["top"].alias("top"), F.trim(F.array_join(ws["text"], " ")).alias("text"), ws.alias("words"))

    def lines(ws):
        starts = F.array_compact(F.transform(ws, lambda w, i: F.when((i == 0) | ~w["top"].eqNullSafe(F.get(ws, i - 1)["top"]), i)))
        return _bind(starts, lambda at: _cut(ws, at, lambda piece, i: _bind(piece, lambda p: line(p, i))))

    return pages.select(*keys, _bind(F.sort_array("ws"), lines).alias("lines"))


def words_to_lines(words: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Words sharing ``round(top, 1)`` form a line, ordered by ``x0``, joined by spaces.

    Output: keys, top, words (array<struct<x0,x1,text>> in x order), text.
    """
    lines = page_lines(words, keys).select(*keys, F.explode("lines").alias("l"))
    return lines.select(*keys, F.col("l.top").alias("top"), F.arrays_zip(
        F.col("l.words.x0").alias("x0"), F.col("l.words.x1").alias("x1"), F.col("l.words.text").alias("text")).alias("words"),
        F.col("l.text").alias("text"))


def drop_noise(lines: DataFrame, fragments: Sequence[str] = NOISE_FRAGMENTS, col: str = "text") -> DataFrame:
    return lines.filter(~_contains_any(F.col(col), fragments))


def page_text(pages: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Lines of each page of :func:`page_lines` joined by newlines (the page's extracted text)."""
    return pages.select(*keys, F.array_join(F.col("lines.text"), "\n").alias("text"))


# ----------------------------------------------------------------- R3-R5

def statement_facts(pages: DataFrame) -> DataFrame:
    """Per file from page 1: statement type, year, closing balance (savings only).

    A file whose page 1 has no words has the default type and year."""
    first = F.max(F.when(F.col("page") == 1, F.col("text")))
    p1 = pages.groupBy("source_file").agg(F.coalesce(first, F.lit("")).alias("text"))
    is_card = _contains_any(F.col("text"), CARD_HEADERS)
    stype = F.when(is_card, F.lit("credit_card")).otherwise(F.lit("savings"))
    sav_year = F.coalesce(F.nullif(F.regexp_extract("text", SAVINGS_YEAR_RE, 1), F.lit("")), F.lit(SAVINGS_DEFAULT_YEAR))
    card_year = F.coalesce(F.nullif(F.regexp_extract("text", CARD_YEAR_RE, 1), F.lit("")), F.lit(CARD_DEFAULT_YEAR))
    closing_txt = F.coalesce(F.nullif(F.regexp_extract("text", CLOSING_RE, 1), F.lit("")),
                             F.nullif(F.regexp_extract("text", GRAND_TOTAL_RE, 1), F.lit("")))
    return p1.select(
        "source_file",
        stype.alias("statement_type"),
        F.when(is_card, card_year).otherwise(sav_year).alias("year"),
        F.when(is_card, F.lit(None)).otherwise(_amount_value(closing_txt)).cast("double").alias("closing_balance"),
    )


# ----------------------------------------------------------------- R6, R7

def _centres(lines: Column) -> Column:
    """Of a page's lines: struct of the centres of the first 'Withdrawals' word and of the first
    'Deposits' and 'Balance' words after it in reading order; NULL without one of them.

    Every later 'Withdrawals' is followed by fewer words, so the first one decides."""
    heads = F.filter(F.flatten(lines["words"]), lambda w: w["text"].isin(*COLUMN_HEADERS))

    def of(heads):
        return _bind(F.array_position(heads["text"], COLUMN_HEADERS[0]), lambda at: F.when(
            at > 0, F.slice(heads, F.greatest(at, F.lit(1)).cast("int"), F.size(heads))))

    def first_of(found, header):
        return F.get(F.filter(found, lambda w: w["text"] == header), F.lit(0))

    def pick(found):
        first = {n: first_of(found, h) for n, h in zip(COLUMNS, COLUMN_HEADERS, strict=True)}
        some = F.lit(True)
        for w in first.values():
            some = some & w.isNotNull()
        return F.when(some, F.struct(*[((w["x0"] + w["x1"]) / 2).alias(n) for n, w in first.items()]))

    return _bind(_bind(heads, of), pick)


def column_centres(words: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Per page: centres of the first 'Withdrawals' word followed (in reading
    order) by a 'Deposits' and a 'Balance' word.  Pages without one are absent.

    Only the three header words take part.
    """
    heads = page_lines(words.filter(F.col("text").isin(*COLUMN_HEADERS)), keys)
    return heads.select(*keys, F.inline(F.array_compact(F.array(_centres(F.col("lines"))))))


def nearest_column(x: Column, centres: dict[str, Column]) -> Column:
    """Name of the centre nearest to ``x``; ties go to the earlier name.

    A CASE over the distances (no per-token array), so it stays cheap inside
    array lambdas."""
    names = list(centres)
    dist = {n: F.abs(x - centres[n]) for n in names}
    expr = None
    for i, n in enumerate(names[:-1]):
        cond = F.lit(True)
        for j, other in enumerate(names):
            if j < i:
                cond = cond & (dist[n] < dist[other])
            elif j > i:
                cond = cond & (dist[n] <= dist[other])
        expr = F.when(cond, F.lit(n)) if expr is None else expr.when(cond, F.lit(n))
    return F.lit(names[0]) if expr is None else expr.otherwise(F.lit(names[-1]))


# --------------------------------------------------------------------- R8

def segment(lines: DataFrame, date_re: str, keys: Sequence[str] = PAGE) -> DataFrame:
    """Number transactions: a line whose first two words match ``date_re`` starts one.

    Adds ``txn`` (1, 2, ... within the page); lines before the first date line are dropped.
    """
    w0 = F.element_at("words", 1)["text"]
    w1 = F.coalesce(F.try_element_at("words", F.lit(2))["text"], F.lit(""))
    is_start = F.concat(w0, F.lit(" "), w1).rlike(date_re)
    w = Window.partitionBy(*keys).orderBy("top").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("txn", F.sum(is_start.cast("int")).over(w)).filter(F.col("txn") > 0)


def _page_transactions(lines: Column, noise: Sequence[str], date_re: str, fn: Callable[[Column, Column], Column]) -> Column:
    """``fn(lines, txn)`` of each transaction of a page: noise dropped, cut at date lines as in :func:`segment`."""
    def is_start(line):
        return F.concat(line["words"][0]["text"], F.lit(" "), F.coalesce(F.get(line["words"], F.lit(1))["text"], F.lit(""))).rlike(date_re)

    def cut(kept):
        starts = F.array_compact(F.transform(kept, lambda line, i: F.when(is_start(line), i)))
        return _bind(starts, lambda at: _cut(kept, at, lambda ls, i: _bind(ls, lambda own: fn(own, (i + 1).cast("bigint")))))

    return _bind(F.filter(lines, lambda line: ~_bind(line["text"], lambda t: _contains_any(t, noise))), cut)


def _day_month(first: Column) -> Column:
    return F.concat_ws(" ", F.slice(first["words"]["text"], 1, 2))


def _dated(rows: DataFrame, years: DataFrame, on: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Transactions of pages with the year of their statement."""
    return rows.join(years, list(on)).select(
        *keys, "txn", "top", F.concat(F.col("day_month"), F.lit(" "), F.col("year")).alias("date"),
        "description", "transaction_type", "amount")


def _join_desc(lines: Column, noise: Sequence[str], ref_re: str) -> Column:
    clean = F.filter(lines, lambda l: ~_contains_any(l, noise) & ~F.trim(l).rlike(ref_re) & (F.length(F.trim(l)) > 1))
    return F.trim(F.array_join(clean, " | "))


# --------------------------------------------------------------------- R9

def _savings_page(lines: Column, centres: Column) -> Column:
    """Transactions of a savings page (array of structs, without the year); NULL without column headers.

    Each transaction's few lines are folded once: what several parts use is bound to a
    lambda's variable, and rows without amount or description are dropped from the array,
    so no filter repeats the folds.
    """
    def is_amount(w):
        return w["text"].rlike(AMOUNT_RE)

    def fold(own, txn, cols):
        first = own[0]

        def amount_token(w, is_first):
            col = _bind((w["x0"] + w["x1"]) / 2, lambda x: nearest_column(x, cols))
            return F.struct(w["text"].alias("text"), F.lit(is_first).alias("first"), col.alias("col"))

        def parts(first_words, later):
            amounts = F.concat(
                F.transform(F.filter(first_words, is_amount), lambda w: amount_token(w, True)),
                F.transform(F.filter(F.flatten(later["words"]), is_amount), lambda w: amount_token(w, False)))
            chosen = F.get(F.filter(amounts, lambda t: t["col"].isin("withdrawal", "deposit")), F.lit(0))
            ttype = F.trim(F.array_join(F.filter(first_words, lambda w: ~is_amount(w))["text"], " "))
            cont = F.filter(later["text"], lambda l: ~F.trim(l).rlike(SAVINGS_REF_RE))
            return F.struct(chosen.alias("chosen"), ttype.alias("ttype"), cont.alias("cont"))

        def row(p):
            chosen, ttype = p["chosen"], p["ttype"]
            keyword = _contains_any(ttype, DEPOSIT_KEYWORDS)
            is_dep = F.when(chosen["first"] & (ttype != ""), keyword).otherwise(chosen["col"] == "deposit")
            desc_lines = F.concat(F.when(ttype != "", F.array(ttype)).otherwise(F.array().cast("array<string>")), p["cont"])
            amount = _bind(_amount_value(chosen["text"]), lambda a: F.when(is_dep, a).otherwise(-a).cast("double"))
            return F.struct(
                txn.alias("txn"), first["top"].alias("top"), _day_month(first).alias("day_month"),
                _join_desc(desc_lines, SAVINGS_NOISE, SAVINGS_REF_RE).alias("description"),
                ttype.alias("transaction_type"), amount.alias("amount"))

        words = first["words"]
        return _bind(_bind(F.slice(words, 3, F.size(words)), lambda fw: _bind(F.slice(own, 2, F.size(own)), lambda later: parts(fw, later))), row)

    def of(c):
        return _page_transactions(lines, SAVINGS_NOISE, SAVINGS_DATE_RE, lambda own, txn: fold(own, txn, {n: c[n] for n in COLUMNS}))

    return _bind(centres, lambda c: F.when(c.isNotNull(), _kept(of(c), SAVINGS_SKIP)))


def _kept(rows: Column, skip: Sequence[str]) -> Column:
    """Transactions with an amount and a description that is none of ``skip``."""
    return F.filter(rows, lambda r: r["amount"].isNotNull() & (r["description"] != "") & ~r["description"].isin(*skip))


def savings_transactions(pages: DataFrame, years: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Savings pages -> transactions (date, description, transaction_type, amount).

    ``pages``: output of :func:`page_lines` for savings pages; only pages with a
    column header take part; ``years``: (source_file, year).
    """
    rows = pages.select(*keys, F.inline(_savings_page(F.col("lines"), _centres(F.col("lines")))))
    return _dated(rows, years, ["source_file"], keys)


# -------------------------------------------------------------------- R10

def _card_page(lines: Column) -> Column:
    """Transactions of a card page (array of structs, without the year); NULL without a transaction-table header."""
    def is_cr_amount(t):
        return t.endswith("CR") & F.trim(F.regexp_replace(t, "CR$", "")).rlike(AMOUNT_RE)

    def tok(w, is_first):
        t = w["text"]
        return _bind(is_cr_amount(t), lambda cr: F.struct(
            t.alias("text"), F.lit(is_first).alias("first"), cr.alias("cr_amt"),
            F.when(cr, F.trim(F.regexp_replace(t, "CR$", ""))).otherwise(t).alias("num"), t.rlike(AMOUNT_RE).alias("amt")))

    init = F.struct(F.lit(None).cast("string").alias("amount"), F.lit(False).alias("credit"))

    def step(acc, t):
        on_first = F.when(t["cr_amt"], F.struct(t["num"].alias("amount"), F.lit(True).alias("credit"))) \
            .when(t["amt"], F.struct(t["text"].alias("amount"), F.lit(False).alias("credit"))) \
            .otherwise(acc)
        later = F.when((t["text"] == "CR") & acc["amount"].isNotNull(), F.struct(acc["amount"].alias("amount"), F.lit(True).alias("credit"))) \
            .when(t["cr_amt"], F.struct(t["num"].alias("amount"), F.lit(True).alias("credit"))) \
            .when(t["amt"] & acc["amount"].isNull(), F.struct(t["text"].alias("amount"), F.lit(False).alias("credit"))) \
            .otherwise(acc)
        return F.when(t["first"], on_first).otherwise(later)

    def fold(own, txn):
        first = own[0]

        def after_dates(rest):
            second_date = (F.size(rest) >= 2) & F.concat(F.get(rest, F.lit(0))["text"], F.lit(" "), F.get(rest, F.lit(1))["text"]).rlike(CARD_DATE_RE)
            return F.when(second_date, F.slice(rest, 3, F.size(rest))).otherwise(rest)

        def parts(head, later):
            tail = F.transform(F.flatten(later["words"]), lambda w: tok(w, False))
            return _bind(F.transform(head, lambda w: tok(w, True)), lambda toks: F.struct(
                F.aggregate(F.concat(toks, tail), init, step).alias("st"),
                F.trim(F.array_join(F.filter(toks, lambda t: ~t["amt"] & ~t["cr_amt"])["text"], " ")).alias("head"),
                F.filter(later["text"], lambda l: ~F.trim(l).rlike(CARD_REF_RE) & ~F.trim(l).rlike(AMOUNT_RE)).alias("cont")))

        def row(p):
            head = p["head"]
            desc_lines = F.concat(
                F.when((head != "") & ~head.isin(*CARD_SKIP), F.array(head)).otherwise(F.array().cast("array<string>")), p["cont"])
            amount = _bind(_amount_value(p["st"]["amount"]), lambda a: F.when(p["st"]["credit"], a).otherwise(-a).cast("double"))
            return F.struct(
                txn.alias("txn"), first["top"].alias("top"), _day_month(first).alias("day_month"),
                _join_desc(desc_lines, NOISE_FRAGMENTS, CARD_REF_RE).alias("description"),
                F.lit("Credit Card").alias("transaction_type"), amount.alias("amount"))

        words = first["words"]
        rest = _bind(F.slice(words, 3, F.size(words)), after_dates)
        return _bind(_bind(rest, lambda head: _bind(F.slice(own, 2, F.size(own)), lambda later: parts(head, later))), row)

    is_card = F.exists(lines["text"], lambda l: _contains_any(l, CARD_HEADERS))
    return F.when(is_card, _kept(_page_transactions(lines, CARD_NOISE, CARD_DATE_RE, fold), CARD_SKIP))


def card_transactions(pages: DataFrame, years: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Card pages -> transactions.  On the date line the last amount wins and a
    'CR' suffix marks a credit; on later lines 'nnCR' always overrides, a plain
    amount only fills a missing one, and a lone 'CR' flips to credit.

    ``pages``: output of :func:`page_lines`; only pages with a transaction-table
    header take part.  The amount rule is an ordered fold (``aggregate``) over
    the tokens of one transaction.
    """
    rows = pages.select(*keys, F.inline(_card_page(F.col("lines"))))
    return _dated(rows, years, ["source_file"], keys)


# --------------------------------------------------------------- pipeline

def parsed_pages(words: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Words of many statements -> one row per page: ``text`` (of page 1 only) and ``parsed``, the transactions of both parsers.

    Words are gathered once by page, and both parsers run over a page's lines in one pass.  Savings pages are those with a column
    header, card pages those with a transaction-table header."""
    lines = F.col("lines")

    def typed(rows, kind):
        some = F.coalesce(rows, F.array().cast("array<struct<txn:bigint,top:double,day_month:string,description:string,transaction_type:string,amount:double>>"))
        return F.transform(some, lambda r: F.struct(F.lit(kind).alias("statement_type"), r.alias("row")))

    parsed = F.concat(typed(_savings_page(lines, _centres(lines)), "savings"), typed(_card_page(lines), "credit_card"))
    return page_lines(words, keys).select(*keys, F.when(F.col("page") == 1, F.array_join(lines["text"], "\n")).alias("text"), parsed.alias("parsed"))


def statement_tables(pages: DataFrame, keys: Sequence[str] = PAGE) -> tuple[DataFrame, DataFrame]:
    """Output of :func:`parsed_pages` -> (transactions, statement facts).

    Page 1 decides each file's type; it is applied at the transaction level (with the year), not by joining every line."""
    facts = statement_facts(pages)
    # Of a plain column, Spark would infer a filter by its size and parse once more below it.
    rows = pages.select(*keys, F.inline(F.concat("parsed"))).select(*keys, "statement_type", "row.*")
    tx = _dated(rows, facts.select("source_file", "statement_type", "year"), ["source_file", "statement_type"], keys).select(
        "source_file", "page", "top", "date", "description", "transaction_type", "amount")
    return tx, facts


def parse_statements(words: DataFrame, keys: Sequence[str] = PAGE) -> tuple[DataFrame, DataFrame]:
    """Words of many statements -> (transactions, statement facts).

    Where both are wanted, write :func:`parsed_pages` and take them from there: then words are gathered and parsed once."""
    # The join with the years drops words of no file; dropped before, both its sides read the same shuffle.
    tx, _ = statement_tables(parsed_pages(words.filter(F.col("source_file").isNotNull()), keys), keys)
    return tx, statement_facts(parsed_pages(words, keys))


# -------------------------------------------------------------------- R13

# Pension statement labels.
BALANCE_LABELS = {
    "ordinary_account": "(?i)Ordinary Account",
    "special_account": "(?i)Special Account",
    "medisave_account": "(?i)MediSave Account",
}
AS_AT_RE = r"(?i)as at\s+(\d{1,2}\s+\w+\s+\d{4})"
DOLLAR_RE = r"\$([\d,]+\.\d{2})"


def labelled_balances(docs: DataFrame, id_col: str = "source_file", text: str = "text",
                      labels: dict[str, str] = BALANCE_LABELS, on_missing: str = "error") -> DataFrame:
    """Per document: date after 'as at' and, per label, the amount of the last
    line that matches the label and holds '$amount'.

    ``on_missing='error'`` fails the job when a label or the date is missing;
    ``'null'`` leaves it NULL (quarantine downstream).
    """
    lines = docs.select(id_col, F.regexp_extract(text, AS_AT_RE, 1).alias("as_at"),
                        F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    amount = F.regexp_extract("line", DOLLAR_RE, 1)
    aggs = [F.first("as_at").alias("as_at")]
    for name, pat in labels.items():
        hit = F.col("line").rlike(pat) & (amount != "")
        aggs.append(F.max_by(F.when(hit, amount), F.when(hit, F.col("pos"))).alias(name))
    g = lines.groupBy(id_col).agg(*aggs)
    d = F.try_to_date(F.initcap(F.lower(F.col("as_at"))), "d MMM yyyy")
    if on_missing == "error":
        d = F.when(d.isNull(), F.raise_error(F.concat(F.lit("missing 'as at' date in "), F.col(id_col)))).otherwise(d)
    out = [id_col, d.alias("statement_date")]
    for name in labels:
        v = _amount_value(F.col(name)).cast("double")
        if on_missing == "error":
            v = F.when(F.col(name).isNull(), F.raise_error(F.concat(F.lit(f"missing {name} in "), F.col(id_col)))).otherwise(v)
        out.append(v.alias(name))
    res = g.select(*out)
    total = F.round(sum((F.col(n).cast("decimal(18,2)") for n in labels), F.lit(0).cast("decimal(18,2)")), 2).cast("double")
    return res.withColumn("total", total)


def checked_balances(docs: DataFrame, id_col: str = "source_file", text: str = "text", labels: dict[str, str] = BALANCE_LABELS) -> DataFrame:
    """:func:`labelled_balances` of every document, with ``reason``: what is missing or unreadable, or NULL."""
    out = labelled_balances(docs, id_col, text, labels, on_missing="null")
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in ("statement_date", *labels)])
    return out.withColumn("reason", F.when(missing != "", F.concat(F.lit("missing "), missing)))
