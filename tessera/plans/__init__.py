"""Jobs: bronze, silver, profile and marts, each a DataFrame transform with
the reader and writer at its edges."""

from tessera.plans.bronze import bronze_layer, bronze_transform
from tessera.plans.marts import (
    additions_mart,
    category_mart,
    multivalue_mart,
    product_fact,
    write_product_fact,
)
from tessera.plans.profile_job import profile_dataset, profile_job, save_profile
from tessera.plans.silver import silver_layer, silver_transform

__all__ = [
    "additions_mart",
    "bronze_layer",
    "bronze_transform",
    "category_mart",
    "multivalue_mart",
    "product_fact",
    "profile_dataset",
    "profile_job",
    "save_profile",
    "silver_layer",
    "silver_transform",
    "write_product_fact",
]
