"""Property class codes.

Fixed values: the assessor's major and minor class codes with their published descriptions.
"""

CLASS_DESCRIPTIONS = {
    "EX": "EXEMPT PROPERTY",
    "RR": "RAILROAD PROPERTY",
    "100": "VACANT LAND",
    "190": "MINOR IMPROVEMENT ON VACANT LAND",
    "200": "RESIDENTIAL LAND",
    "201": "RESIDENTIAL GARAGE",
    "202": "ONE-STORY RESIDENCE, ANY AGE, UP TO 999 SQUARE FEET",
    "203": "ONE-STORY RESIDENCE, ANY AGE, 1,000 TO 1,800 SQUARE FEET",
    "204": "ONE-STORY RESIDENCE, ANY AGE, 1,801 SQUARE FEET AND OVER",
    "205": "TWO-OR-MORE STORY RESIDENCE, OVER 62 YEARS OF AGE UP TO 2,200 SQUARE FEET",
    "206": "TWO-OR-MORE STORY RESIDENCE, OVER 62 YEARS OF AGE, 2,201 TO 4,999 SQUARE FEET",
    "207": "TWO-OR-MORE STORY RESIDENCE, UP TO 62 YEARS OF AGE, UP TO 2,000 SQUARE FEET",
    "208": "TWO-OR-MORE STORY RESIDENCE, UP TO 62 YEARS OF AGE, 3,801 TO 4,999 SQUARE FEET",
    "209": "TWO-OR-MORE STORY RESIDENCE, ANY AGE, 5,000 SQUARE FEET AND OVER",
    "210": "OLD STYLE ROW HOUSE (TOWN HOME), OVER 62 YEARS OF AGE",
    "211": "APARTMENT BUILDING WITH 2 TO 6 UNITS, ANY AGE",
    "212": "MIXED-USE COMMERCIAL/RESIDENTIAL BUILDING WITH APARTMENT AND COMMERCIAL AREA TOTALING 6 UNITS OR LESS WITH A SQUARE FOOT AREA LESS THAN 20,000 SQUARE FEET, ANY AGE",
    "213": "COOPERATIVE",
    "218": "A RESIDENTIAL BUILDING LICENSED AS A BED & BREAKFAST BY THE MUNICIPALITY, COUNTY OF COOK OR REGISTERED AS A BED & BREAKFAST WITH THE STATE OF ILLINOIS UNDER 50 ILCS 820/1 ET.SEQ., WITH SIX OR FEWER RENTABLE UNITS AND WHERE ONE UNIT IS OWNER OCCUPIED AND IS ENTITLED TO A HOMEOWNERS EXEMPTION PURSUANT TO THE PROPERTY TAX CODE.",
    "219": "A RESIDENTIAL BUILDING LICENSED AS A BED & BREAKFAST BY THE MUNICIPALITY, COUNTY OF COOK OR REGISTERED AS A BED & BREAKFAST WITH THE STATE OF ILLINOIS UNDER 50 ILCS 820/1 ET.SEQ., WITH SIX OR FEWER RENTABLE UNITS AND WHERE NONE OF THE UNITS IS OWNER OCCUPIED AND NO HOMEOWNERS EXEMPTION IS ALLOWED PURSUANT TO THE PROPERTY TAX CODE.",
    "224": "FARM BUILDING",
    "225": "SINGLE-ROOM OCCUPANCY RENTAL BUILDING",
    "234": "SPLIT LEVEL RESIDENCE WITH A LOWER LEVEL BELOW GRADE (GROUND LEVEL) ALL AGES, ALL SIZES",
    "236": "ANY RESIDENCE LOCATED ON A PARCEL USED PRIMARILY FOR COMMERCIAL OR INDUSTRIAL PURPOSES",
    "239": "NON-EQUALIZED LAND UNDER AGRICULTURAL USE, VALUED AT FARM PRICING",
    "240": "FIRST-TIME AGRICULTURAL USE OF LAND VALUED AT MARKET PRICE",
    "241": "VACANT LAND UNDER COMMON OWNERSHIP WITH ADJACENT RESIDENCE",
    "278": "TWO-OR-MORE STORY RESIDENCE, UP TO 62 YEARS OF AGE, 2,001 TO 3,800 SQUARE FEET",
    "288": "HOME IMPROVEMENT EXEMPTION",
    "290": "MINOR IMPROVEMENT",
    "295": "INDIVIDUALLY-OWNED TOWNHOME OR ROW HOUSE UP TO 62 YEARS OF AGE",
    "297": "SPECIAL RESIDENTIAL IMPROVEMENTS (MAY APPLY TO CONDO BUILDING IN FIRST YEAR OF CONSTRUCTION BEFORE DIVISION INTO INDIVIDUAL UNITS.)",
    "299": "RESIDENTIAL CONDOMINIUM",
    "300": "LAND USED IN CONJUNCTION WITH RENTAL APARTMENTS",
    "301": "GARAGE USED IN CONJUNCTION WITH RENTAL APARTMENTS",
    "313": "TWO-OR-THREE-STORY, BUILDING, SEVEN OR MORE UNITS",
    "314": "TWO-OR-THREE-STORY, NON-FIREPROOF BUILDING WITH CORRIDOR APARTMENT OR CALIFORNIA TYPE APARTMENTS, NO CORRIDORS EXTERIOR ENTRANCE",
    "315": "TWO-OR-THREE-STORY, NON-FIREPROOF CORRIDOR APARTMENTS OR CALIFORNIA TYPE APARTMENTS, INTERIOR ENTRANCE",
    "318": "MIXED-USE COMMERCIAL/RESIDENTIAL BUILDING WITH APARTMENTS AND COMMERCIAL AREA TOTALING SEVEN UNITS OR MORE WITH A SQUARE-FOOT AREA OF OVER 20,000 SQUARE FEET",
    "390": "OTHER MINOR IMPROVEMENT RELATED TO RENTAL USE",
    "391": "APARTMENT BUILDING OVER THREE STORIES, SEVEN OR MORE UNITS",
    "396": "RENTED MODERN ROW HOUSES, SEVEN OR MORE UNITS IN A SINGLE DEVELOPMENT OR ONE OR MORE CONTIGUOUS PARCELS IN COMMON OWNERSHIP",
    "397": "SPECIAL RENTAL STRUCTURE",
    "399": "RENTAL CONDOMINIUM",
    "400": "NOT-FOR-PROFIT LAND",
    "401": "NOT-FOR-PROFIT GARAGE",
    "417": "NOT-FOR-PROFIT ONE STORY COMMERCIAL BUILDING",
    "418": "NOT-FOR-PROFIT TWO-OR-THREE STORY MIXED USE COMMERCIAL/RESIDENTIAL BUILDING",
    "422": "NOT-FOR-PROFIT ONE-STORY NON-FIREPROOF PUBLIC GARAGE",
    "423": "NOT-FOR-PROFIT GASOLINE STATION",
    "426": "NOT-FOR-PROFIT COMMERCIAL GREENHOUSE",
    "427": "NOT-FOR-PROFIT THEATRE",
    "428": "NOT-FOR-PROFIT BANK BUILDING",
    "429": "NOT-FOR-PROFIT MOTEL",
    "430": "NOT-FOR-PROFIT SUPERMARKET",
    "431": "NOT-FOR-PROFIT SHOPPING CENTER",
    "432": "NOT-FOR-PROFIT BOWLING ALLEY",
    "433": "NOT-FOR-PROFIT QUONSET HUT OR BUTLER TYPE BUILDING",
    "435": "NOT-FOR-PROFIT GOLF COURSE IMPROVEMENT",
    "480": "NOT-FOR-PROFIT INDUSTRIAL MINOR IMPROVEMENT",
    "481": "NOT-FOR-PROFIT GARAGE USED IN CONJUNCTION WITH INDUSTRIAL IMPROVEMENT",
    "483": "NOT-FOR-PROFIT INDUSTRIAL QUONSET HUT OR BUTLER TYPE BUILDING",
    "487": "NOT-FOR-PROFIT SPECIAL INDUSTRIAL IMPROVEMENT",
    "489": "NOT-FOR-PROFIT INDUSTRIAL CONDOMINIUM",
    "490": "NOT-FOR-PROFIT COMMERCIAL MINOR IMPROVEMENT",
    "491": "NOT-FOR-PROFIT IMPROVEMENT OVER THREE STORIES",
    "492": "NOT-FOR-PROFIT, TWO-OR-THREE STORY BUILDING CONTAINING PART OR ALL RETAIL AND/OR COMMERCIAL SPACE",
    "493": "NOT-FOR-PROFITINDUSTRIAL BUILDING",
    "496": "NOT-FOR-PROFIT, RENTED MODERN ROW HOUSES, SEVEN OR MORE UNITS IN A SINGLE DEVELOPMENT",
    "497": "NOT-FOR-PROFIT SPECIAL STRUCTURE",
    "499": "NOT-FOR-PROFIT CONDOMINIUM",
    "500": "COMMERCIAL LAND",
    "501": "GARAGE USED IN CONJUNCTION WITH COMMERCIAL IMPROVEMENTS",
    "516": "NON-FIREPROOF HOTEL OR ROOMING HOUSE (APARTMENT HOTEL)",
    "517": "ONE-STORY COMMERCIAL BUILDING",
    "522": "ONE-STORY, NON-FIREPROOF PUBLIC GARAGE",
    "523": "GASOLINE STATION",
    "526": "COMMERCIAL GREENHOUSE",
    "527": "THEATRE",
    "528": "BANK BUILDING",
    "529": "MOTEL",
    "530": "SUPERMARKET",
    "531": "SHOPPING CENTER",
    "532": "BOWLING ALLEY",
    "533": "QUONSET HUT OR BUTLER TYPE BUILDING",
    "535": "GOLF COURSE LAND",
    "550": "INDUSTRIAL LAND",
    "580": "INDUSTRIAL MINOR IMPROVEMENT",
    "581": "GARAGE USED IN CONJUNCTION WITH INDUSTRIAL IMPROVEMENT",
    "583": "INDUSTRIAL QUONSET HUT OR BUTLER TYPE BUILDING",
    "587": "SPECIAL INDUSTRIAL IMPROVEMENT",
    "589": "INDUSTRIAL CONDOMINIUM UNIT",
    "590": "COMMERCIAL MINOR IMPROVEMENT",
    "591": "COMMERCIAL BUILDING OVER THREE STORIES",
    "592": "TWO-OR-THREE-STORY BUILDING CONTAINING PART OR ALL RETAIL AND/OR COMMERCIAL SPACE",
    "593": "INDUSTRIAL BUILDING",
    "597": "SPECIAL COMMERCIAL STRUCTURE",
    "599": "COMMERCIAL CONDOMINIUM UNIT",
    "637": "INDUSTRIAL BROWNFIELD LAND",
    "638": "INDUSTRIAL BROWNFIELD",
    "650": "INDUSTRIAL LAND",
    "651": "INDUSTRIAL LAND",
    "654": "OTHER INDUSTRIAL BROWNFIELD MINOR IMPROVEMENTS",
    "655": "GARAGE USED IN CONJUNCTION WITH INDUSTRIAL BROWNFIELD INCENTIVE IMPROVEMENT",
    "663": "INDUSTRIAL BUILDING",
    "666": "INDUSTRIAL BROWNFIELD QUONSET HUT OR BUTLER TYPE BUILDING",
    "668": "SPECIAL INDUSTRIAL BROWNFIELD IMPROVEMENT",
    "669": "INDUSTRIAL BROWNFIELD CONDOMINIUM UNIT",
    "670": "INDUSTRIAL MINOR IMPROVEMENT",
    "671": "GARAGE USED IN CONJUNCTION WITH INDUSTRIAL INCENTIVE IMPROVEMENT",
    "673": "INDUSTRIAL QUONSET HUT OR BUTLER TYPE BUILDING",
    "677": "SPECIAL INDUSTRIAL IMPROVEMENT",
    "679": "INDUSTRIAL CONDOMINIUM UNIT",
    "680": "INDUSTRIAL MINOR IMPROVEMENT",
    "681": "GARAGE USED IN CONJUNCTION WITH INDUSTRIAL INCENTIVE IMPROVEMENT",
    "683": "INDUSTRIAL QUONSET HUT OR BUTLER TYPE BUILDING",
    "687": "SPECIAL INDUSTRIAL IMPROVEMENT",
    "689": "INDUSTRIAL CONDOMINIUM UNIT",
    "693": "INDUSTRIAL BUILDING",
    "700": "COMMERCIAL INCENTIVE LAND",
    "701": "GARAGE USED IN CONJUNCTION WITH COMMERCIAL INCENTIVE IMPROVEMENT",
    "716": "NON-FIREPROOF HOTEL OR ROOMING HOUSE (APARTMENT HOTEL)",
    "717": "ONE-STORY COMMERCIAL USE BUILDING",
    "722": "GARAGE, SERVICE STATION",
    "723": "GASOLINE STATION, WITH /WITHOUT BAYS, STORE",
    "726": "COMMERCIAL GREENHOUSE",
    "727": "THEATRE",
    "728": "BANK BUILDING",
    "729": "MOTEL",
    "730": "SUPERMARKET",
    "731": "SHOPPING CENTER",
    "732": "BOWLING ALLEY",
    "733": "QUONSET HUT OR BUTLER TYPE BUILDING",
    "735": "GOLF COURSE LAND",
    "742": "COMMERCIAL INCENTIVE LAND",
    "743": "GARAGE USED IN CONJUNCTION WITH COMMERCIAL INCENTIVE IMPROVEMENT",
    "745": "GOLF COURSE LAND",
    "746": "NON-FIREPROOF HOTEL OR ROOMING HOUSE (APARTMENT HOTEL)",
    "747": "ONE-STORY COMMERCIAL BUILDING",
    "748": "MOTEL",
    "752": "GARAGE, SERVICE STATION",
    "753": "GASOLINE STATION, WITH/WITHOUT BAYS, STORE",
    "756": "COMMERCIAL GREENHOUSE",
    "757": "THEATRE",
    "758": "BANK BUILDING",
    "760": "SUPERMARKET",
    "761": "SHOPPING CENTER (REGIONAL, COMMUNITY, NEIGHBORHOOD, PROMOTIONAL, SPECIALTY)",
    "762": "BOWLING ALLEY",
    "764": "QUONSET HUT OR BUTLER TYPE BUILDING",
    "765": "OTHER MINOR COMMERCIAL IMPROVEMENTS",
    "767": "SPECIAL COMMERCIAL STRUCTURE",
    "772": "TWO-OR-THREE-STORY BUILDING, CONTAINING PART OR ALL RETAIL AND/OR COMMERCIAL SPACE",
    "774": "OFFICE BUILDING",
    "790": "OTHER MINOR COMMERCIAL IMPROVEMENT",
    "791": "OFFICE BUILDING (ONE STORY, LOW, RISE, MID RISE, HIGH RISE)",
    "792": "TWO-OR-THREE-STORY BUILDING CONTAINING PART OR ALL RETAIL AND/OR COMMERCIAL SPACE",
    "797": "SPECIAL COMMERCIAL STRUCTURE",
    "798": "COMMERCIAL/INDUSTRIAL-CONDOMINIUM UNITS/GARAGE",
    "799": "COMMERCIAL/INDUSTRIAL-CONDOMINIUM UNIT/GARAGE",
    "800": "COMMERCIAL INCENTIVE LAND",
    "801": "GARAGE USED IN CONJUNCTION WITH COMMERCIAL INCENTIVE IMPROVEMENT",
    "816": "NON-FIREPROOF HOTEL OR ROOMING HOUSE (APARTMENT HOTEL)",
    "817": "ONE-STORY COMMERCIAL BUILDING",
    "822": "GARAGE, SERVICE STATION",
    "823": "GASOLINE STATION WITH/WITHOUT BAY, STORE",
    "826": "COMMERCIAL GREENHOUSE",
    "827": "THEATRE",
    "828": "BANK BUILDING",
    "829": "MOTEL",
    "830": "SUPERMARKET",
    "831": "SHOPPING CENTER (REGIONAL, COMMUNITY, NEIGHBORHOOD, PROMOTIONAL, SPECIALTY)",
    "832": "BOWLING ALLEY",
    "833": "QUONSET HUT OR BUTLER TYPE BUILDING",
    "835": "GOLF COURSE LAND",
    "850": "INDUSTRIAL INCENTIVE LAND",
    "880": "INDUSTRIAL MINOR IMPROVEMENT",
    "881": "GARAGE USED IN CONJUNCTION WITH INDUSTRIAL INCENTIVE IMPROVEMENT",
    "883": "QUONSET HUT OR BUTLER TYPE BUILDING",
    "887": "SPECIAL INDUSTRIAL IMPROVEMENT",
    "889": "INDUSTRIAL CONDOMINIUM UNIT",
    "890": "MINOR INDUSTRIAL IMPROVEMENT",
    "891": "OFFICE BUILDING",
    "892": "TWO-OR-THREE-STORY BUILDING CONTAINING PART OR ALL RETAIL AND/OR COMMERCIAL SPACE",
    "893": "INDUSTRIAL BUILDING",
    "897": "SPECIAL COMMERCIAL STRUCTURE",
    "899": "COMMERCIAL/INDUSTRIAL CONDOMINIUM UNIT/GARAGE",
    "900": "LAND USED IN CONJUNCTION WITH INCENTIVE RENTAL APARTMENTS",
    "901": "GARAGE USED IN CONJUNCTION WITH INCENTIVE RENTAL APARTMENT",
    "913": "TWO-OR-THREE-STORY APARTMENT BUILDING, SEVEN OR MORE UNITS",
    "914": "TWO-OR-THREE-STORY, NON-FIREPROOF COURT AND CORRIDOR APARTMENTS OR CALIFORNIA TYPE APARTMENTS, NO CORRIDORS, EXTERIOR ENTRANCE",
    "915": "TWO-OR-THREE-STORY NON-FIREPROOF CORRIDOR APARTMENTS, OR CALIFORNIA TYPE APARTMENTS, INTERIOR ENTRANCE",
    "918": "MIXED USE COMMERCIAL/RESIDENTIAL BUILDING WITH APARTMENTS AND COMMERCIAL AREA WHERE THE COMMERCIAL AREA IS GRANTED AN INCENTIVE USE",
    "959": "RENTAL CONDOMINIUM UNIT",
    "990": "OTHER MINOR IMPROVEMENTS",
    "991": "APARTMENT BUILDINGS OVER THREE STORIES",
    "996": "RENTED MODERN ROW HOUSES, SEVEN OR MORE UNITS IN A SINGLE DEVELOPMENT OR ONE OR MORE CONTIGUOUS PARCELS IN COMMON OWNERSHIP",
    "997": "SPECIAL RENTAL STRUCTURE",
}
