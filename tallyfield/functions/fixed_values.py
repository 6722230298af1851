"""Code lists, labels and column lists given by the data sets.

Nothing here is logic. The values follow the published data dictionaries and
are listed in their natural order.
"""

# State code, postal abbreviation, name.
STATES = """
01 AL Alabama
02 AK Alaska
04 AZ Arizona
05 AR Arkansas
06 CA California
08 CO Colorado
09 CT Connecticut
10 DE Delaware
11 DC District of Columbia
12 FL Florida
13 GA Georgia
15 HI Hawaii
16 ID Idaho
17 IL Illinois
18 IN Indiana
19 IA Iowa
20 KS Kansas
21 KY Kentucky
22 LA Louisiana
23 ME Maine
24 MD Maryland
25 MA Massachusetts
26 MI Michigan
27 MN Minnesota
28 MS Mississippi
29 MO Missouri
30 MT Montana
31 NE Nebraska
32 NV Nevada
33 NH New Hampshire
34 NJ New Jersey
35 NM New Mexico
36 NY New York
37 NC North Carolina
38 ND North Dakota
39 OH Ohio
40 OK Oklahoma
41 OR Oregon
42 PA Pennsylvania
44 RI Rhode Island
45 SC South Carolina
46 SD South Dakota
47 TN Tennessee
48 TX Texas
49 UT Utah
50 VT Vermont
51 VA Virginia
53 WA Washington
54 WV West Virginia
55 WI Wisconsin
56 WY Wyoming
72 PR Puerto Rico
"""

# Labels of the coded person columns.
MARITAL_STATUS = {
    1: "Married",
    2: "Widowed",
    3: "Divorced",
    4: "Separated",
    5: "Never married",
}
SEX = {1: "Male", 2: "Female"}
RACE = {
    1: "White",
    2: "Black or African American",
    3: "American Indian or Alaska Native",
    4: "Asian",
    5: "Native Hawaiian or Pacific Islander",
    6: "Other Race",
    7: "Two or More Races",
}
EMPLOYMENT = {
    1: "Employed - at work",
    2: "Employed - not at work",
    3: "Unemployed",
    4: "Armed Forces - at work",
    5: "Armed Forces - not at work",
    6: "Not in labor force",
}

# Words that mark a weather condition as bad.
BAD_WEATHER_WORDS = (
    "Rain", "Snow", "Drizzle", "Thunder", "T-Storm", "Fog", "Haze", "Overcast",
    "Windy", "Storm", "Ice",
)

# Ages below the bound carry the label; the last label is open.
ACCIDENT_AGE_BANDS = ((25, "18-24"), (40, "25-39"), (60, "40-59"))
ACCIDENT_AGE_LAST = "60+"
PEER_AGE_BANDS = (
    (18, "Under 18"), (26, "18-25"), (36, "26-35"), (46, "36-45"), (56, "46-55"),
)
PEER_AGE_LAST = "56+"
VISIBILITY_BANDS = ((1, "Low (<1 mi)"), (5, "Moderate (1-5 mi)"))
VISIBILITY_LAST = "High (>5 mi)"

# Person columns in file order.
PERSON_COLUMNS = """
RT string, SERIALNO string, DIVISION int, SPORDER int, PUMA int, REGION int, ST string,
ADJINC int, PWGTP int, AGEP int, CIT string, CITWP float, COW float, DDRS float, DEAR int,
DEYE int, DOUT float, DPHY float, DRAT float, DRATX float, DREM float, ENG float, FER float,
GCL float, GCM float, GCR float, HIMRKS int, HINS1 int, HINS2 int, HINS3 int, HINS4 int,
HINS5 int, HINS6 int, HINS7 int, INTP float, JWMNP float, JWRIP float, JWTRNS float, LANX float,
MAR int, MARHD float, MARHM float, MARHT float, MARHW float, MARHYP float, MIG float, MIL float,
MLPA float, MLPB float, MLPCD float, MLPE float, MLPFG float, MLPH float, MLPIK float,
MLPJ float, NWAB float, NWAV float, NWLA float, NWLK float, NWRE float, OIP float, PAP float,
RELSHIPP int, RETP float, SCH float, SCHG float, SCHL float, SEMP float, SEX int, SSIP float,
SSP float, WAGP float, WKHP float, WKL float, WKWN float, WRK float, YOEP float, ANC int,
ANC1P int, ANC2P int, DECADE float, DIS string, DRIVESP float, ESP float, ESR float,
FOD1P float, FOD2P float, HICOV int, HISP int, INDP float, JWAP float, JWDP float, LANP float,
MIGPUMA float, MIGSP float, MSP float, NAICSP string, NATIVITY int, NOP string, OC string,
OCCP string, PAOC string, PERNP string, PINCP string, POBP int, POVPIP string, POWPUMA string,
POWSP string, PRIVCOV int, PUBCOV int, QTRBIR int, RAC1P int, RAC2P int, RAC3P int, RACAIAN int,
RACASN int, RACBLK int, RACNH int, RACNUM int, RACPI int, RACSOR int, RACWHT int, RC float,
SCIENGP float, SCIENGRLP float, SFN float, SFR float, SOCP string, VPS float, WAOB int,
FAGEP int, FANCP int, FCITP int, FCITWP int, FCOWP int, FDDRSP int, FDEARP int, FDEYEP int,
FDISP int, FDOUTP int, FDPHYP int, FDRATP int, FDRATXP int, FDREMP int, FENGP int, FESRP int,
FFERP int, FFODP int, FGCLP int, FGCMP int, FGCRP int, FHICOVP int, FHIMRKSP int, FHINS1P int,
FHINS2P int, FHINS3C string, FHINS3P int, FHINS4C string, FHINS4P int, FHINS5C string,
FHINS5P int, FHINS6P int, FHINS7P int, FHISP int, FINDP int, FINTP int, FJWDP int, FJWMNP int,
FJWRIP int, FJWTRNSP int, FLANP int, FLANXP int, FMARP int, FMARHDP int, FMARHMP int,
FMARHTP int, FMARHWP int, FMARHYP int, FMIGP int, FMIGSP int, FMILPP int, FMILSP int, FOCCP int,
FOIP int, FPAP int, FPERNP int, FPINCP int, FPOBP int, FPOWSP int, FPRIVCOVP int, FPUBCOVP int,
FRACP int, FRELSHIPP int, FRETP int, FSCHGP int, FSCHLP int, FSCHP int, FSEMP int, FSEXP int,
FSSIP int, FSSP int, FWAGP int, FWKHP int, FWKLP int, FWKWNP int, FWRKP int, FYOEP int
"""
# The replicate weights PWGTP1, PWGTP2 and so on follow.
PERSON_REPLICATE_WEIGHTS = 80

# Incident columns in file order.
INCIDENT_COLUMNS = """
ID string, Source string, Severity int, Start_Time string, End_Time string, Start_Lat float,
Start_Lng float, End_Lat float, End_Lng float, Distance(mi) float, Description string,
Street string, City string, County string, State string, Zipcode string, Country string,
Timezone string, Airport_Code string, Weather_Timestamp string, Temperature(F) float,
Wind_Chill(F) float, Humidity(%) float, Pressure(in) float, Visibility(mi) float,
Wind_Direction string, Wind_Speed(mph) float, Precipitation(in) float, Weather_Condition string,
Amenity boolean, Bump boolean, Crossing boolean, Give_Way boolean, Junction boolean,
No_Exit boolean, Railway boolean, Roundabout boolean, Station boolean, Stop boolean,
Traffic_Calming boolean, Traffic_Signal boolean, Turning_Loop boolean, Sunrise_Sunset string,
Civil_Twilight string, Nautical_Twilight string, Astronomical_Twilight string
"""

# Coverage columns in file order. Block codes have 15 digits.
COVERAGE_COLUMNS = """
LogRecNo int, Provider_Id int, FRN int, ProviderName string, DBAName string,
HoldingCompanyName string, HocoNum int, HocoFinal string, StateAbbr string, BlockCode long,
TechCode int, Consumer int, MaxAdDown float, MaxAdUp float, Business int
"""
