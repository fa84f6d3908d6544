"""The static dimension: electricity-grid regions and the datacenter regions they supply."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_SCHEMA = (
    "grid_region string, region_name string, city string, country string, country_code string, "
    "latitude double, longitude double, grid_operator string, cloud_providers string, "
    "gcp_regions string, aws_regions string, azure_regions string"
)

# The 49 known grid regions, one per line, columns as in SEED_SCHEMA.
GRID_REGIONS = """
US-CA-CISO|California ISO|San Francisco|United States|US|37.7749|-122.4194|CAISO|GCP, AWS, Azure|us-west1|us-west-1|West US
US-OR|Oregon|Portland|United States|US|45.5152|-122.6784|BPA|GCP, AWS, Azure|us-west2|us-west-2|West US 2
US-VA-PJM|Virginia PJM|Ashburn|United States|US|37.4316|-77.4024|PJM|AWS, Azure||us-east-1|East US
US-NC|North Carolina|Charlotte|United States|US|35.7596|-79.0193|Duke Energy|GCP, Azure|us-east1||East US 2
US-OH|Ohio|Columbus|United States|US|39.9612|-82.9988|PJM|AWS, Azure||us-east-2|Central US
US-TX-ERCOT|Texas ERCOT|Dallas|United States|US|30.2672|-97.7431|ERCOT|GCP, Azure|us-south1||South Central US
US-IA-MISO|Iowa MISO|Council Bluffs|United States|US|41.5868|-93.6250|MISO|GCP, Azure|us-central1||North Central US
US-NV|Nevada|Las Vegas|United States|US|36.1699|-115.1398|NV Energy|GCP, Azure|us-west4||West US 3
US-FL|Florida|Miami|United States|US|27.9506|-81.7605|FPL|Azure|||Florida
CA-ON|Ontario|Toronto|Canada|CA|43.6532|-79.3832|IESO|GCP, Azure|northamerica-northeast1||Canada Central
CA-QC|Quebec|Montreal|Canada|CA|45.5017|-73.5673|Hydro-Québec|GCP, Azure|northamerica-northeast2||Canada East
CA-AB|Alberta|Calgary|Canada|CA|51.0447|-114.0719|AESO|GCP|northamerica-northeast3||
BR-SP|São Paulo|São Paulo|Brazil|BR|-23.5505|-46.6333|ONS|GCP, AWS, Azure|southamerica-east1|sa-east-1|Brazil South
CL|Chile|Santiago|Chile|CL|-33.4489|-70.6693|Coordinador|AWS||sa-east-2|
GB|United Kingdom|London|United Kingdom|GB|51.5074|-0.1278|National Grid ESO|GCP, AWS, Azure|europe-west2|eu-west-2|UK South
IE|Ireland|Dublin|Ireland|IE|53.3498|-6.2603|EirGrid|GCP, AWS, Azure|europe-west1|eu-west-1|North Europe
NL|Netherlands|Amsterdam|Netherlands|NL|52.3676|4.9041|TenneT|GCP, Azure|europe-west4||West Europe
BE|Belgium|Brussels|Belgium|BE|50.8503|4.3517|Elia|GCP, Azure|europe-west1||West Europe
FR|France|Paris|France|FR|48.8566|2.3522|RTE|GCP, AWS, Azure|europe-west9|eu-west-3|France Central
ES|Spain|Madrid|Spain|ES|40.4168|-3.7038|REE|GCP, Azure|europe-southwest1||Spain Central
DE|Germany|Frankfurt|Germany|DE|52.5200|13.4050|50Hertz/Amprion/TenneT/TransnetBW|GCP, AWS, Azure|europe-west3|eu-central-1|Germany West Central
CH|Switzerland|Zurich|Switzerland|CH|47.3769|8.5417|Swissgrid|GCP, AWS, Azure|europe-west6|eu-central-2|Switzerland North
AT|Austria|Vienna|Austria|AT|48.2082|16.3738|APG|Azure|||Austria East
PL|Poland|Warsaw|Poland|PL|52.2297|21.0122|PSE|GCP, Azure|europe-central2||Poland Central
SE|Sweden|Stockholm|Sweden|SE|59.3293|18.0686|Svenska Kraftnät|GCP, Azure|europe-north1||Sweden Central
NO|Norway|Oslo|Norway|NO|59.9139|10.7522|Statnett|Azure|||Norway East
FI|Finland|Helsinki|Finland|FI|60.1699|24.9384|Fingrid|GCP, AWS, Azure|europe-north1|eu-north-1|Finland
DK|Denmark|Copenhagen|Denmark|DK|55.6761|12.5683|Energinet|Azure|||Denmark East
IT|Italy|Milan|Italy|IT|41.9028|12.4964|Terna|GCP, AWS, Azure|europe-west8|eu-south-1|Italy North
AE|United Arab Emirates|Dubai|United Arab Emirates|AE|25.2048|55.2708|DEWA/TRANSCO|GCP, AWS, Azure|me-west1|me-south-1|UAE North
IL|Israel|Tel Aviv|Israel|IL|32.0853|34.7818|Israel Electric Corporation|GCP, AWS, Azure|me-west1|il-central-1|Israel Central
BH|Bahrain|Manama|Bahrain|BH|26.0667|50.5577|EWA|AWS||me-south-1|
SA|Saudi Arabia|Riyadh|Saudi Arabia|SA|24.7136|46.6753|SEC|Azure|||Saudi Arabia
JP-TK|Japan Tokyo|Tokyo|Japan|JP|35.6762|139.6503|TEPCO|GCP, AWS, Azure|asia-northeast1|ap-northeast-1|Japan East
JP-OS|Japan Osaka|Osaka|Japan|JP|34.6937|135.5023|KEPCO|GCP, AWS, Azure|asia-northeast2|ap-northeast-3|Japan West
KR|South Korea|Seoul|South Korea|KR|37.5665|126.9780|KPX|GCP, AWS, Azure|asia-northeast3|ap-northeast-2|Korea Central
TW|Taiwan|Taipei|Taiwan|TW|25.0330|121.5654|Taipower|GCP, Azure|asia-east1||Taiwan
HK|Hong Kong|Hong Kong|Hong Kong|HK|22.3193|114.1694|CLP/HEC|GCP, AWS, Azure|asia-east2|ap-east-1|Hong Kong
SG|Singapore|Singapore|Singapore|SG|1.3521|103.8198|EMA|GCP, AWS, Azure|asia-southeast1|ap-southeast-1|Southeast Asia
ID|Indonesia|Jakarta|Indonesia|ID|-6.2088|106.8456|PLN|GCP, AWS, Azure|asia-southeast2|ap-southeast-3|Indonesia
MY|Malaysia|Kuala Lumpur|Malaysia|MY|3.1390|101.6869|TNB|Azure|||Malaysia South
TH|Thailand|Bangkok|Thailand|TH|13.7563|100.5018|EGAT|AWS||ap-southeast-4|
IN-MH|India Mumbai|Mumbai|India|IN|19.0760|72.8777|MSETCL|GCP, AWS, Azure|asia-south1|ap-south-1|Central India
IN-TG|India Hyderabad|Hyderabad|India|IN|17.3850|78.4867|TSTRANSCO|GCP, AWS, Azure|asia-south2|ap-south-2|South India
IN-DL|India Delhi|Delhi|India|IN|28.7041|77.1025|POSOCO|GCP, Azure|asia-south2||North India
AU-NSW|Australia NSW|Sydney|Australia|AU|-33.8688|151.2093|AEMO|GCP, AWS, Azure|australia-southeast1|ap-southeast-2|Australia East
AU-VIC|Australia Victoria|Melbourne|Australia|AU|-37.8136|144.9631|AEMO|GCP, Azure|australia-southeast2||Australia Southeast
NZ|New Zealand|Auckland|New Zealand|NZ|-36.8485|174.7633|Transpower|Azure|||New Zealand North
ZA|South Africa|Johannesburg|South Africa|ZA|-33.9249|18.4241|Eskom|GCP, AWS, Azure|africa-south1|af-south-1|South Africa North
"""


def seed_rows() -> list[tuple]:
    rows = []
    for line in GRID_REGIONS.strip().splitlines():
        cells = line.split("|")
        rows.append((*cells[:5], float(cells[5]), float(cells[6]), *cells[7:]))
    return rows


def seed_grid_regions(spark: SparkSession) -> DataFrame:
    """49 rows by construction, split on the JVM side, so Spark knows that they are few."""
    lines = spark.range(1).select(F.explode(F.split(F.lit(GRID_REGIONS.strip()), "\n")).alias("line"))
    cells = lines.select(F.split("line", r"\|").alias("cells"))
    columns = [part.split() for part in SEED_SCHEMA.split(", ")]
    return cells.select(
        *[F.col("cells")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(columns)]
    )
