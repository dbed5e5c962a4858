"""Fixed domain values. They must equal the published ones for results to match."""

from __future__ import annotations

# Airport code, latitude, longitude, name (row order is the airport id).
AIRPORTS = [
    ("CXB", 21.4523, 91.9636, "Cox's Bazar Airport"),
    ("CCU", 22.6547, 88.4467, "Netaji Subhas Chandra Bose International Airport, Kolkata"),
    ("BZL", 22.8010, 90.3015, "Barisal Airport"),
    ("CGP", 22.2500, 91.8133, "Shah Amanat International Airport, Chittagong"),
    ("ZYL", 24.9632, 91.8665, "Osmani International Airport, Sylhet"),
    ("KUL", 2.7456, 101.7072, "Kuala Lumpur International Airport"),
    ("SPD", 25.7592, 88.9080, "Saidpur Airport"),
    ("YYZ", 43.6777, -79.6248, "Toronto Pearson International Airport"),
    ("RJH", 24.4441, 88.6186, "Shah Makhdum Airport, Rajshahi"),
    ("DAC", 23.8433, 90.4055, "Hazrat Shahjalal International Airport, Dhaka"),
    ("JSR", 23.1837, 89.1610, "Jessore Airport"),
    ("LHR", 51.4700, -0.4543, "London Heathrow Airport"),
    ("DEL", 28.5562, 77.1000, "Indira Gandhi International Airport, Delhi"),
    ("IST", 41.2753, 28.7519, "Istanbul Airport"),
    ("DXB", 25.2532, 55.3657, "Dubai International Airport"),
    ("SIN", 1.3644, 103.9915, "Singapore Changi Airport"),
    ("BKK", 13.6900, 100.7501, "Suvarnabhumi Airport, Bangkok"),
    ("DOH", 25.2730, 51.6080, "Hamad International Airport, Doha"),
    ("JFK", 40.6413, -73.7781, "John F. Kennedy International Airport, New York"),
    ("JED", 21.6796, 39.1565, "King Abdulaziz International Airport, Jeddah"),
]

# Codes of the home airports (a route between two of them is domestic).
HOME_AIRPORTS = ["DAC", "CGP", "ZYL", "CXB", "JSR", "BZL", "RJH", "SPD"]

EARTH_RADIUS_KM = 6371.0

# Allowed categories of the request form.
AIRLINES = [
    "Malaysian Airlines", "Cathay Pacific", "British Airways", "Singapore Airlines",
    "IndiGo", "US-Bangla Airlines", "AirAsia", "Etihad Airways", "Gulf Air",
    "Emirates", "Air India", "Saudia", "Thai Airways", "Kuwait Airways",
    "FlyDubai", "NovoAir", "Air Astra", "SriLankan Airlines", "Biman Bangladesh Airlines",
    "Qatar Airways", "Vistara", "Turkish Airlines", "Lufthansa", "Air Arabia",
]
AIRCRAFT_TYPES = ["Airbus A320", "Boeing 787", "Boeing 737", "Airbus A350", "Boeing 777"]
CLASSES = ["Economy", "Business", "First Class"]
BOOKING_SOURCES = ["Online Website", "Travel Agency", "Direct Booking"]
STOPOVERS = ["Direct", "1 Stop", "2 Stops"]
SEASONALITY = ["Regular", "Winter Holidays", "Eid", "Hajj"]

# Month number -> season and month number -> seasonality label.
SEASON_MONTHS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}
SEASONALITY_MONTHS = {
    "Winter Holidays": (12, 1),
    "Eid": (3, 4),
    "Hajj": (6,),
}

# Travel class -> rank, and upper ends of the hour-of-day bins 0..3.
CLASS_RANKS = {"Economy": 0, "Business": 1, "First Class": 2}
HOUR_BIN_ENDS = (5, 11, 17, 23)

# Column names of the production table, by the short names used here.
PRODUCTION_COLUMNS = {
    "airline": "Airline",
    "source": "Source",
    "source_name": "Source Name",
    "destination": "Destination",
    "destination_name": "Destination Name",
    "departure_ts": "Departure Date & Time",
    "arrival_ts": "Arrival Date & Time",
    "duration_hrs": "Duration (hrs)",
    "stopovers": "Stopovers",
    "aircraft_type": "Aircraft Type",
    "class": "Class",
    "booking_source": "Booking Source",
    "base_fare": "Base Fare (BDT)",
    "tax": "Tax & Surcharge (BDT)",
    "total_fare": "Total Fare (BDT)",
    "seasonality": "Seasonality",
    "days_before": "Days Before Departure",
}

# Run gates.
MIN_TRAINING_ROWS = 1000
PROMOTION_GAIN = 0.02
BACKUP_KEEP_DAYS = 30
BACKUP_KEEP_RUNS = 5

# Split and cross-validation defaults.
TEST_FRACTION = 0.2
SEED = 42
CV_FOLDS = 5
