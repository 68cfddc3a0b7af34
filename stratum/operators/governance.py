"""Governance as user-level operators (H1, H2).

Row-level tenant scoping is a semi-join against a grants table, so the
filter is planned like any other join (and pushed below aggregations by
Catalyst), and Spark chooses its strategy from the measured sizes.
Column masking uses built-in string and hash functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.silver import phone_standardize


def tenant_grants(tenants: DataFrame) -> DataFrame:
    """Grants derived from the tenant table: ``admin`` sees every tenant,
    ``analyst_<plan>`` the tenants on that plan."""
    admin = tenants.select(F.lit("admin").alias("principal"), F.col("id").alias("tenant_id"))
    by_plan = tenants.select(F.concat(F.lit("analyst_"), F.col("plan_type")).alias("principal"),
                             F.col("id").alias("tenant_id"))
    return admin.unionByName(by_plan)


def tenant_scope(df: DataFrame, grants: DataFrame, principal: str) -> DataFrame:
    """H1: rows of ``df`` whose tenant the principal is granted."""
    allowed = grants.where(F.col("principal") == principal).select("tenant_id")
    return df.join(allowed, "tenant_id", "left_semi")


def mask_email(email: Column) -> Column:
    """First character, then '***@' and the domain."""
    return F.concat(F.substring(email, 1, 1), F.lit("***@"), F.substring_index(email, "@", -1))


def mask_phone(phone: Column) -> Column:
    """Digits of the standardised number replaced by '*' except the last four."""
    d = phone_standardize(phone)
    return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(d) - 4, F.lit(0))), F.right(d, F.lit(4)))


def pii_mask(customers: DataFrame, role: str, hash_key: str) -> DataFrame:
    """H2: customer contact data as a role may see it (``admin`` sees it in clear).

    ``email_hash`` joins records without showing the address; it is keyed
    (HMAC-like, key before and after), so a list of known addresses does not
    reverse it without ``hash_key``, which stays with the data owner.
    """
    if role == "admin":
        email, phone = F.col("email"), F.col("phone")
    else:
        email, phone = mask_email(F.col("email")), mask_phone(F.col("phone"))
    return customers.select("id", "tenant_id", email.alias("email"), phone.alias("phone"),
                            F.sha2(F.concat(F.lit(hash_key), F.sha2(F.concat(F.lit(hash_key), F.col("email")), 256)), 256)
                            .alias("email_hash"))
