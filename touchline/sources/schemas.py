"""Raw shapes of the football API, as far as the staging reads them. Fixed values."""

AREA = "id long, name string, countryCode string, flag string, parentAreaId long, parentArea string"

COMPETITION = (
    "id long, area struct<name:string>, name string, code string, type string, "
    "currentSeason struct<id:long>, lastUpdated string"
)

SCORE_PAIR = "struct<home:int,away:int>"

MATCH = (
    "id long, utcDate string, status string, matchday int, stage string, lastUpdated string, "
    "area struct<id:long>, competition struct<id:long>, season struct<id:long>, "
    "homeTeam struct<id:long>, awayTeam struct<id:long>, "
    "referees array<struct<id:long,name:string,nationality:string>>, "
    f"score struct<winner:string,duration:string,fullTime:{SCORE_PAIR},halfTime:{SCORE_PAIR}>"
)

TEAM = (
    "id long, name string, shortName string, tla string, area struct<name:string>, address string, "
    "website string, crest string, founded double, clubColors string, venue string, "
    "runningCompetitions array<struct<id:long>>, squad array<struct<id:long>>, "
    "coach struct<id:long,firstName:string,lastName:string,name:string,dateOfBirth:string,"
    "nationality:string,contract:struct<start:string,until:string>>"
)

TEAM_PARENTS = {
    "competition": "struct<id:long,name:string>",
    "season": "struct<id:long,startDate:string,endDate:string,winner:struct<id:long>>",
}

PERSON = (
    "id long, name string, firstName string, lastName string, dateOfBirth string, nationality string, "
    "section string, position string, shirtNumber int, lastUpdated string, "
    "currentTeam struct<id:long,contract:struct<start:string,until:string>>"
)
