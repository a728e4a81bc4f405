"""Values that must equal the published ones for results to match."""

from __future__ import annotations

# English stop words left out of the word ranking.
STOP_WORDS = (
    "i", "the", "you", "to", "and", "a", "it", "me", "not", "in",
    "my", "is", "of", "that", "do", "your", "on", "am", "we", "are",
    "all", "will", "for", "be", "no", "have", "so", "but", "was",
    "can", "if", "this", "with", "they", "he", "she", "her", "his",
    "what", "when", "them", "at", "an", "just", "or", "there", "from",
    "been", "had", "has", "did", "were", "would", "could", "should",
    "their", "our", "about", "who", "how", "which", "than", "its",
    "these", "those", "then", "only", "also", "more", "some", "as",
)

# Year ranges of the partitioned track table.
YEAR_RANGE_START, YEAR_RANGE_END, YEAR_RANGE_STEP = 1920, 2030, 10

# Clustering columns of the stored raw tables.
CLUSTER_COLUMNS = {
    "tracks": ("artist_name",),
    "genres": ("genre",),
    "lyrics": ("track_id", "word"),
}

# Rows per written file of the lyrics dataset.
LYRICS_ROWS_PER_FILE = 500_000

# Models built at a time.
MODEL_THREADS = 4

# Panel thresholds.
TREND_FIRST_YEAR, TREND_MIN_TRACKS = 1920, 50
CONFIDENCE_Z = 1.96
PANEL_MAX_RANK, PANEL_WORDS, PANEL_MIN_LENGTH = 20, 15, 3
FINGERPRINT_GENRES = ("Pop", "Electronic", "Jazz", "Metal")
OPACITY_SLOPE, OPACITY_FLOOR = 0.7, 0.3
DIVERSITY_METRICS = ("avg_type_token_ratio", "avg_vocab_size", "avg_total_words")

# Country codes (ISO 3166-1) and display names, "iso2,iso3,name".
COUNTRY_CODES = """\
AD,AND,Andorra
AE,ARE,United Arab Emirates
AF,AFG,Afghanistan
AG,ATG,Antigua and Barbuda
AI,AIA,Anguilla
AL,ALB,Albania
AM,ARM,Armenia
AO,AGO,Angola
AR,ARG,Argentina
AT,AUT,Austria
AU,AUS,Australia
AZ,AZE,Azerbaijan
BA,BIH,Bosnia and Herzegovina
BB,BRB,Barbados
BD,BGD,Bangladesh
BE,BEL,Belgium
BF,BFA,Burkina Faso
BG,BGR,Bulgaria
BH,BHR,Bahrain
BI,BDI,Burundi
BJ,BEN,Benin
BM,BMU,Bermuda
BN,BRN,Brunei
BO,BOL,Bolivia
BR,BRA,Brazil
BS,BHS,Bahamas
BT,BTN,Bhutan
BW,BWA,Botswana
BY,BLR,Belarus
BZ,BLZ,Belize
CA,CAN,Canada
CD,COD,DR Congo
CF,CAF,Central African Republic
CG,COG,Congo
CH,CHE,Switzerland
CI,CIV,Ivory Coast
CL,CHL,Chile
CM,CMR,Cameroon
CN,CHN,China
CO,COL,Colombia
CR,CRI,Costa Rica
CU,CUB,Cuba
CV,CPV,Cape Verde
CY,CYP,Cyprus
CZ,CZE,Czechia
DE,DEU,Germany
DJ,DJI,Djibouti
DK,DNK,Denmark
DM,DMA,Dominica
DO,DOM,Dominican Republic
DZ,DZA,Algeria
EC,ECU,Ecuador
EE,EST,Estonia
EG,EGY,Egypt
ER,ERI,Eritrea
ES,ESP,Spain
ET,ETH,Ethiopia
FI,FIN,Finland
FJ,FJI,Fiji
FR,FRA,France
GA,GAB,Gabon
GB,GBR,United Kingdom
GD,GRD,Grenada
GE,GEO,Georgia
GH,GHA,Ghana
GM,GMB,Gambia
GN,GIN,Guinea
GQ,GNQ,Equatorial Guinea
GR,GRC,Greece
GT,GTM,Guatemala
GW,GNB,Guinea-Bissau
GY,GUY,Guyana
HK,HKG,Hong Kong
HN,HND,Honduras
HR,HRV,Croatia
HT,HTI,Haiti
HU,HUN,Hungary
ID,IDN,Indonesia
IE,IRL,Ireland
IL,ISR,Israel
IM,IMN,Isle of Man
IN,IND,India
IQ,IRQ,Iraq
IR,IRN,Iran
IS,ISL,Iceland
IT,ITA,Italy
JM,JAM,Jamaica
JO,JOR,Jordan
JP,JPN,Japan
KE,KEN,Kenya
KG,KGZ,Kyrgyzstan
KH,KHM,Cambodia
KI,KIR,Kiribati
KM,COM,Comoros
KN,KNA,Saint Kitts and Nevis
KP,PRK,North Korea
KR,KOR,South Korea
KW,KWT,Kuwait
KZ,KAZ,Kazakhstan
LA,LAO,Laos
LB,LBN,Lebanon
LC,LCA,Saint Lucia
LI,LIE,Liechtenstein
LK,LKA,Sri Lanka
LR,LBR,Liberia
LS,LSO,Lesotho
LT,LTU,Lithuania
LU,LUX,Luxembourg
LV,LVA,Latvia
LY,LBY,Libya
MA,MAR,Morocco
MC,MCO,Monaco
MD,MDA,Moldova
ME,MNE,Montenegro
MG,MDG,Madagascar
MK,MKD,North Macedonia
ML,MLI,Mali
MM,MMR,Myanmar
MN,MNG,Mongolia
MQ,MTQ,Martinique
MR,MRT,Mauritania
MT,MLT,Malta
MU,MUS,Mauritius
MV,MDV,Maldives
MW,MWI,Malawi
MX,MEX,Mexico
MY,MYS,Malaysia
MZ,MOZ,Mozambique
NA,NAM,Namibia
NE,NER,Niger
NG,NGA,Nigeria
NI,NIC,Nicaragua
NL,NLD,Netherlands
NO,NOR,Norway
NP,NPL,Nepal
NZ,NZL,New Zealand
OM,OMN,Oman
PA,PAN,Panama
PE,PER,Peru
PG,PNG,Papua New Guinea
PH,PHL,Philippines
PK,PAK,Pakistan
PL,POL,Poland
PR,PRI,Puerto Rico
PS,PSE,Palestine
PT,PRT,Portugal
PY,PRY,Paraguay
QA,QAT,Qatar
RE,REU,Reunion
RO,ROU,Romania
RS,SRB,Serbia
RU,RUS,Russia
RW,RWA,Rwanda
SA,SAU,Saudi Arabia
SB,SLB,Solomon Islands
SC,SYC,Seychelles
SD,SDN,Sudan
SE,SWE,Sweden
SG,SGP,Singapore
SI,SVN,Slovenia
SK,SVK,Slovakia
SL,SLE,Sierra Leone
SN,SEN,Senegal
SO,SOM,Somalia
SR,SUR,Suriname
SS,SSD,South Sudan
SV,SLV,El Salvador
SY,SYR,Syria
SZ,SWZ,Eswatini
TD,TCD,Chad
TG,TGO,Togo
TH,THA,Thailand
TJ,TJK,Tajikistan
TL,TLS,Timor-Leste
TM,TKM,Turkmenistan
TN,TUN,Tunisia
TO,TON,Tonga
TR,TUR,Turkey
TT,TTO,Trinidad and Tobago
TW,TWN,Taiwan
TZ,TZA,Tanzania
UA,UKR,Ukraine
UG,UGA,Uganda
US,USA,United States
UY,URY,Uruguay
UZ,UZB,Uzbekistan
VA,VAT,Vatican City
VC,VCT,Saint Vincent
VE,VEN,Venezuela
VI,VIR,U.S. Virgin Islands
VN,VNM,Vietnam
VU,VUT,Vanuatu
WS,WSM,Samoa
YE,YEM,Yemen
ZA,ZAF,South Africa
ZM,ZMB,Zambia
ZW,ZWE,Zimbabwe
"""
