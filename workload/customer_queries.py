"""Customers, products and document text: cleansing, privacy, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.functions.dates import age_years as age
from tillwork.functions.privacy import sha256_hex, stars
from tillwork.functions.text import text_length
from tillwork.operators import enrich
from tillwork.operators.cleanse import dedup, drop_nulls, fill_nulls, type_ints
from tillwork.operators.ordering import top_k
from tillwork.operators.protect import hash_columns, mask_columns
from tillwork.plans import enrichment, layers, report
from tillwork.schemas import CUSTOMERS
from workload.entities import (
    CUSTOMERS_SQL,
    PRODUCTS_SQL,
    customers,
    products,
    table,
    with_copies,
)
from workload.registry import iso, query

AS_OF = "2024-01-01"

COMPLETE = " AND ".join(f"{name} IS NOT NULL" for name in CUSTOMERS.fieldNames())
BIRTH_SQL = "CAST(strptime(BirthDate, '%-m/%-d/%Y') AS DATE)"
AGE_SQL = f"date_diff('day', {BIRTH_SQL}, DATE '{AS_OF}') / 365"
# Whole amounts only: digits with a sign, within the range of the type.
DIGITS_SQL = (
    "nullif(regexp_extract(regexp_replace(AnnualIncome, '[$, ]', '', 'g'), '^[+-]?[0-9]+$'), '')"
)
INCOME_SQL = f"TRY_CAST({DIGITS_SQL} AS INTEGER)"
AMOUNT_SQL = f"TRY_CAST({DIGITS_SQL} AS BIGINT)"
BAND_SQL = (
    f"CASE WHEN {AMOUNT_SQL} < 50000 THEN 'Low' WHEN {AMOUNT_SQL} < 100000 THEN 'Medium' "
    "ELSE 'High' END"
)
NAME_SQL = "concat_ws(' ', Prefix, FirstName, LastName)"
MASK_SQL = f"""repeat('*', length({NAME_SQL})) AS masked_name,
    repeat('*', length(EmailAddress)) AS masked_email,
    repeat('*', length(Address)) AS masked_address,
    repeat('*', length(PhoneNumber)) AS masked_phone"""
SIZE_SQL = (
    "CASE ProductSize WHEN 'Small' THEN 'S' WHEN 'Medium' THEN 'M' WHEN 'Large' THEN 'L' "
    "ELSE 'Unknown' END"
)
DISCOUNT_SQL = "ProductPrice * CAST(0.9 AS DOUBLE)"


@query(f"WITH {CUSTOMERS_SQL} SELECT * FROM customers WHERE {COMPLETE}")
def customers_drop_nulls(spark, sf_dir):
    return drop_nulls(customers(spark, sf_dir))


@query(
    f"""WITH {PRODUCTS_SQL} SELECT * FROM products
    WHERE ProductColor IS NOT NULL AND ProductSize IS NOT NULL"""
)
def products_drop_nulls(spark, sf_dir):
    return drop_nulls(products(spark, sf_dir))


@query(
    f"""WITH {CUSTOMERS_SQL}
    SELECT * REPLACE (coalesce(EmailAddress, '') AS EmailAddress) FROM customers"""
)
def customers_fill_nulls(spark, sf_dir):
    return fill_nulls(customers(spark, sf_dir), {"EmailAddress": ""})


@query(
    f"""WITH {PRODUCTS_SQL} SELECT * REPLACE (coalesce(ProductColor, '') AS ProductColor,
    coalesce(ProductSize, '') AS ProductSize) FROM products"""
)
def products_fill_nulls(spark, sf_dir):
    return fill_nulls(products(spark, sf_dir), {"ProductColor": "", "ProductSize": ""})


@query(f"WITH {CUSTOMERS_SQL} SELECT * FROM customers")
def customers_dedup(spark, sf_dir):
    return dedup(with_copies(customers(spark, sf_dir), "Occupation = 'MACHINERY'"))


@query(f"WITH {PRODUCTS_SQL} SELECT DISTINCT ProductName, ProductSize FROM products")
def products_dedup(spark, sf_dir):
    return dedup(products(spark, sf_dir).select("ProductName", "ProductSize"))


@query(f"WITH {CUSTOMERS_SQL} SELECT CustomerKey, {NAME_SQL} AS FullName FROM customers")
def full_name_concat_ws(spark, sf_dir):
    return enrich.with_full_name(customers(spark, sf_dir)).select("CustomerKey", "FullName")


@query(
    f"""WITH {CUSTOMERS_SQL}
    SELECT CustomerKey, FirstName || ' ' || LastName AS FullName FROM customers"""
)
def full_name_concat(spark, sf_dir):
    return enrich.with_strict_full_name(customers(spark, sf_dir)).select("CustomerKey", "FullName")


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT CustomerKey, sha256({NAME_SQL}) AS FullName,
    sha256(EmailAddress) AS EmailAddress, sha256(PhoneNumber) AS PhoneNumber,
    sha256(Address) AS Address FROM customers"""
)
def hash_customer_pii(spark, sf_dir):
    named = enrich.with_full_name(customers(spark, sf_dir))
    return hash_columns(named).select(
        "CustomerKey", "FullName", "EmailAddress", "PhoneNumber", "Address"
    )


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT CustomerKey, sha256('pepper' || PhoneNumber) AS PhoneNumber,
    sha256('pepper' || EmailAddress) AS EmailAddress FROM customers"""
)
def hash_customer_pii_salted(spark, sf_dir):
    hashed = hash_columns(customers(spark, sf_dir), ["PhoneNumber", "EmailAddress"], "pepper")
    return hashed.select("CustomerKey", "PhoneNumber", "EmailAddress")


@query("SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS key_hash FROM customer")
def hash_numeric_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", sha256_hex("c_custkey").alias("key_hash")
    )


@query("SELECT doc_id, sha256(text) AS text_hash FROM documents")
def hash_document_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sha256_hex("text").alias("text_hash"))


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT CustomerKey, {MASK_SQL} FROM customers"""
)
def mask_customer_pii(spark, sf_dir):
    masked = mask_columns(enrich.with_full_name(customers(spark, sf_dir)))
    return masked.select(
        "CustomerKey", "masked_name", "masked_email", "masked_address", "masked_phone"
    )


@query("SELECT conv_id, turn, role, repeat('*', length(text)) AS masked_text FROM conversations")
def mask_conversation_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", stars("text").alias("masked_text")
    )


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS num_chars FROM documents")
def document_length(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", text_length("text").alias("num_chars"))


@query(
    f"""SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') / 365 AS Age
    FROM orders"""
)
def age_years(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", age(F.to_date("o_orderdate"), AS_OF).alias("Age")
    )


@query("SELECT o_orderkey, date_diff('day', o_orderdate::DATE, current_date) / 365 AS Age FROM orders")
def age_today(spark, sf_dir):
    """Ages that refer to the current date of each engine."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", age(F.to_date("o_orderdate")).alias("Age")
    )


@query(f"WITH {CUSTOMERS_SQL} SELECT CustomerKey, {INCOME_SQL} AS AnnualIncome FROM customers")
def income_to_int(spark, sf_dir):
    return type_ints(customers(spark, sf_dir), "AnnualIncome").select("CustomerKey", "AnnualIncome")


@query(f"WITH {CUSTOMERS_SQL} SELECT CustomerKey, {BAND_SQL} AS IncomeCategory FROM customers")
def income_band(spark, sf_dir):
    return enrich.with_income_category(customers(spark, sf_dir)).select(
        "CustomerKey", "IncomeCategory"
    )


@query(f"WITH {PRODUCTS_SQL} SELECT ProductKey, {SIZE_SQL} AS ProductSizeCategory FROM products")
def size_code(spark, sf_dir):
    return enrich.with_size_category(products(spark, sf_dir)).select(
        "ProductKey", "ProductSizeCategory"
    )


@query(f"WITH {PRODUCTS_SQL} SELECT ProductKey, {DISCOUNT_SQL} AS DiscountedPrice FROM products")
def product_discount(spark, sf_dir):
    return enrich.with_discounted_price(products(spark, sf_dir)).select(
        "ProductKey", "DiscountedPrice"
    )


@query(
    f"""WITH {PRODUCTS_SQL}
    SELECT ProductKey, ProductPrice - ProductCost AS ProductProfit FROM products"""
)
def product_profit(spark, sf_dir):
    return enrich.with_profit(products(spark, sf_dir)).select("ProductKey", "ProductProfit")


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT CustomerKey, sha256({NAME_SQL}) AS FullName,
    strftime({BIRTH_SQL}, '%Y-%m-%d') AS BirthDate, MaritalStatus,
    sha256(EmailAddress) AS EmailAddress, AnnualIncome, TotalChildren, EducationLevel, Occupation,
    HomeOwner, sha256(PhoneNumber) AS PhoneNumber, sha256(Address) AS Address
    FROM (SELECT DISTINCT * FROM customers WHERE {COMPLETE})"""
)
def customer_cleansed(spark, sf_dir):
    doubled = with_copies(customers(spark, sf_dir), "Occupation = 'MACHINERY'")
    cleansed = layers.customers_cleansed(doubled)
    return cleansed.select(iso("BirthDate"), *[c for c in cleansed.columns if c != "BirthDate"])


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT *, {NAME_SQL} AS FullName, {AGE_SQL} AS Age,
    {BAND_SQL} AS IncomeCategory FROM customers"""
)
def customer_enriched(spark, sf_dir):
    return enrichment.customers_enriched(customers(spark, sf_dir), AS_OF)


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT * EXCLUDE (EmailAddress, Address, PhoneNumber,
    Prefix, FirstName, LastName),
    {AGE_SQL} AS Age, {MASK_SQL} FROM customers"""
)
def customer_masked(spark, sf_dir):
    return enrichment.customers_masked(customers(spark, sf_dir), AS_OF)


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT *, {NAME_SQL} AS FullName,
    {AGE_SQL} AS Age, {MASK_SQL} FROM customers"""
)
def customer_masked_with_originals(spark, sf_dir):
    return enrichment.customers_masked(customers(spark, sf_dir), AS_OF, drop_originals=False)


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT * REPLACE (coalesce(EmailAddress, '') AS EmailAddress,
    {INCOME_SQL} AS AnnualIncome, CAST(TotalChildren AS INTEGER) AS TotalChildren),
    FirstName || ' ' || LastName AS FullName FROM customers"""
)
def customer_curated(spark, sf_dir):
    return enrichment.customers_curated(customers(spark, sf_dir))


@query(
    f"""WITH {PRODUCTS_SQL} SELECT * REPLACE (coalesce(ProductColor, '') AS ProductColor,
    coalesce(ProductSize, '') AS ProductSize), {DISCOUNT_SQL} AS DiscountedPrice FROM products"""
)
def product_curated(spark, sf_dir):
    return enrichment.products_curated(products(spark, sf_dir))


@query(
    f"""WITH {PRODUCTS_SQL} SELECT *,
    CAST(length(ProductDescription) AS INTEGER) AS ProductDescriptionLength,
    ProductPrice - ProductCost AS ProductProfit FROM products"""
)
def product_profiled(spark, sf_dir):
    return enrichment.products_profiled(products(spark, sf_dir))


@query(
    f"""WITH {PRODUCTS_SQL} SELECT *, {DISCOUNT_SQL} AS DiscountedPrice,
    {SIZE_SQL} AS ProductSizeCategory FROM products"""
)
def product_sized(spark, sf_dir):
    return enrichment.products_sized(products(spark, sf_dir))


@query(
    f"""WITH {PRODUCTS_SQL} SELECT *,
    CAST(length(ProductDescription) AS INTEGER) AS ProductDescriptionLength,
    ProductPrice - ProductCost AS ProductProfit, {DISCOUNT_SQL} AS DiscountedPrice,
    {SIZE_SQL} AS ProductSizeCategory FROM products"""
)
def product_enriched(spark, sf_dir):
    return enrichment.products_enriched(products(spark, sf_dir))


@query(
    f"WITH {PRODUCTS_SQL} SELECT * FROM products ORDER BY ProductPrice DESC, ProductKey LIMIT 1"
)
def highest_priced_product(spark, sf_dir):
    return report.highest_priced(products(spark, sf_dir))


@query(
    f"WITH {PRODUCTS_SQL} SELECT * FROM products ORDER BY ProductPrice DESC, ProductKey LIMIT 10"
)
def top_k_products(spark, sf_dir):
    return report.highest_priced(products(spark, sf_dir), 10)


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100"""
)
def top_k_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_k(orders, "o_totalprice", 100, tie_breakers=["o_orderkey"])


@query(f"WITH {PRODUCTS_SQL} SELECT DISTINCT * FROM products ORDER BY ProductName, ProductKey")
def products_sorted(spark, sf_dir):
    return report.products_by_name(products(spark, sf_dir))
