"""What several test modules share; imported by this name, which no other module has."""

SMALL = "/root/testdata/sf0.001"

# A record that passes all rules.
GOOD = {
    "ID": "1",
    "Case Number": "A1",
    "Date": "05/03/2001 10:20:30 AM",
    "Primary Type": "THEFT",
    "Year": 2001,
    "Latitude": 41.5,
    "Longitude": -87.5,
}
