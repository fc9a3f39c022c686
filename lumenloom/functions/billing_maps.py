"""Fixed lookups of the billing report."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service code -> service category; anything else is Other.
SERVICE_CATEGORY = {
    "AmazonEC2": "Compute",
    "AWSLambda": "Compute",
    "AmazonECS": "Compute",
    "AmazonEKS": "Compute",
    "AmazonElasticContainerService": "Compute",
    "AWSBatch": "Compute",
    "AmazonS3": "Storage",
    "AmazonEBS": "Storage",
    "AmazonRDS": "Databases",
    "AmazonDynamoDB": "Databases",
    "AmazonRedshift": "Databases",
    "AmazonElastiCache": "Databases",
    "AmazonOpenSearchService": "Databases",
    "AmazonRoute53": "Networking",
    "AmazonAPIGateway": "Networking",
    "AmazonCloudFront": "Networking",
    "AWSDirectConnect": "Networking",
    "AWSTransit": "Networking",
    "AWSKeyManagementService": "Identity",
    "AWSCertificateManager": "Identity",
    "AmazonCognito": "Identity",
    "AWSSecretsManager": "Identity",
    "AmazonCloudWatch": "Management and Governance",
    "AWSCloudFormation": "Management and Governance",
    "AWSSystemsManager": "Management and Governance",
    "AWSConfig": "Management and Governance",
    "AmazonKinesis": "Analytics",
    "AmazonKinesisFirehose": "Analytics",
    "AmazonMSK": "Analytics",
    "AmazonAthena": "Analytics",
    "AWSGlue": "Analytics",
}

# Service code -> resource type; anything else keeps its code.
RESOURCE_TYPE = {
    "AmazonEC2": "Instance",
    "AmazonS3": "Bucket",
    "AWSLambda": "Function",
    "AmazonRDS": "DBInstance",
    "AmazonDynamoDB": "Table",
}

# Record type -> charge category; anything else is Usage.
CHARGE_CATEGORY = {
    "Usage": "Usage",
    "DiscountedUsage": "Usage",
    "SavingsPlanCoveredUsage": "Usage",
    "Credit": "Credit",
    "Tax": "Tax",
    "Refund": "Refund",
    "SavingsPlanUpfrontFee": "Adjustment",
    "SavingsPlanRecurringFee": "Adjustment",
    "SavingsPlanNegation": "Adjustment",
}

# Record types whose quantity already is an amount in USD.
USD_RECORD_TYPES = ["Credit", "Refund", "Tax", "SavingsPlanUpfrontFee", "SavingsPlanRecurringFee"]


def _lookup(table: dict[str, str], c: Column) -> Column:
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(literal, c)


def service_category(service: Column) -> Column:
    return F.coalesce(_lookup(SERVICE_CATEGORY, service), F.lit("Other"))


def resource_type(service: Column) -> Column:
    return F.coalesce(_lookup(RESOURCE_TYPE, service), service)


def charge_category(record_type: Column) -> Column:
    return F.coalesce(_lookup(CHARGE_CATEGORY, record_type), F.lit("Usage"))


def is_usd(record_type: Column) -> Column:
    return F.coalesce(record_type.isin(USD_RECORD_TYPES), F.lit(False))
