"""Fixed values of the football warehouse: they decide results, so they are stated as they are declared, in that order."""

import datetime as dt

CHAMPIONS_LEAGUE = "2001"
BRAZILIAN_LEAGUE = "2013"
COPA_LIBERTADORES = "2152"

# their seasons lie within one calendar year, so the source still holds last year's matches
SINGLE_YEAR_COMPETITIONS = (2152, 2013)

DEFAULT_BIRTH_DATE = dt.date(1995, 1, 1)

COUNTRY_NAME_BY_ID = {
    2030: "Bosnia-Herzegovina",
    2192: "Ireland",
    2083: "North Macedonia",
    2123: "South Korea",
}

CONTINENT_NAMES = {"N/C America": "North America"}

BIRTH_DATE_BY_PLAYER = {
    191106: dt.date(2005, 1, 4),
    191127: dt.date(1998, 5, 12),
    263454: dt.date(2007, 5, 9),
    170381: dt.date(1993, 2, 19),
    160790: dt.date(2004, 4, 6),
    191811: DEFAULT_BIRTH_DATE,
}

NATIONALITY_BY_PLAYER = {192652: "Brazil"}

NATIONALITY_NAMES = {
    "UA Emirates": "United Arab Emirates",
    "DR Congo": "Congo DR",
    "Ivory Coast": "Côte d’Ivoire",
    "São Tomé and Príncipe": "São Tomé e Príncipe",
    "USA": "United States",
}

NATIONALITY_BY_REFEREE = {80747: "Spain", 167782: "Israel", 176741: "Portugal"}

FOUNDATION_BY_TEAM = {
    "Sheffield United FC": dt.date(1889, 1, 1),
    "AVS": dt.date(2023, 1, 1),
    "CF Estrela da Amadora": dt.date(2020, 1, 1),
}

PLAYOFF_STAGE_ORDER = {"final": 10, "semi finals": 20, "quarter finals": 30, "last 16": 40, "playoffs": 50}

MAIN_COMPETITION_IDS = [
    "2013",
    "2016",
    "2021",
    "2001",
    "2018",
    "2015",
    "2002",
    "2019",
    "2003",
    "2017",
    "2014",
    "2000",
]

POSITIONS = [
    "Centre-Forward",
    "Midfield",
    "Left Midfield",
    "Defence",
    "Left-Back",
    "Attacking Midfield",
    "Goalkeeper",
    "Centre-Back",
    "Right Midfield",
    "Right Winger",
    "Offence",
    "Central Midfield",
    "Left Winger",
    "Right-Back",
    "Defensive Midfield",
]

COMPETITION_NAMES = [
    "UEFA Champions League",
    "Bundesliga",
    "Championship",
    "Campeonato Brasileiro Série A",
    "Premier League",
    "Ligue 1",
    "Serie A",
    "Eredivisie",
    "Copa Libertadores",
    "FIFA World Cup",
    "Primeira Liga",
    "European Championship",
    "Primera Division",
]

MATCH_STAGES = [
    "regular season",
    "round 1",
    "group stage",
    "round 2",
    "round 3",
    "quarter finals",
    "semi finals",
    "last 16",
    "playoffs",
    "final",
    "league stage",
]

KNOCKOUT_STAGES = list(PLAYOFF_STAGE_ORDER)

MATCH_STATUSES = ["awarded", "finished", "in play", "paused", "postponed", "scheduled", "timed"]

CONTINENTS = ["Africa", "Asia", "Europe", "North America", "Oceania", "South America", "World"]

MONTHS = {
    "January": "Jan", "February": "Feb", "March": "Mar", "April": "Apr", "May": "May", "June": "Jun",
    "July": "Jul", "August": "Aug", "September": "Sep", "October": "Oct", "November": "Nov", "December": "Dec",
}

MAX_MATCHES = 46  # of a team in a season
MAX_POINTS = 3 * MAX_MATCHES
MAX_TEAMS = 24
MAX_SEASON_GOALS = 190
