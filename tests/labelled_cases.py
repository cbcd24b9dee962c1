"""Descriptions whose right fields are known.

(description, damage type, urgency, injury mentioned, third party involved); the first eighteen are the templates the
keyword rules were written for, the others are new to them.
"""

TEMPLATES = 18

CASES = [
    ("Rear-ended at a traffic light, bumper and trunk damaged.", "collision", "medium", False, True),
    ("Hit a pole while parking, front left headlight broken.", "collision", "low", False, False),
    ("Windshield cracked by a stone on the highway.", "collision", "low", False, False),
    ("Car was broken into overnight, window smashed and radio stolen.", "theft", "medium", False, True),
    ("Collision at a roundabout, other driver did not stop. Door dented.", "collision", "medium", False, True),
    ("Water leak from the upstairs neighbour, kitchen ceiling stained.", "water", "medium", False, True),
    ("Burst pipe in the bathroom flooded the hallway.", "water", "high", False, False),
    ("Storm blew tiles off the roof, rain coming in to the bedroom.", "weather", "high", False, False),
    ("Break-in while on holiday, laptop and jewellery missing.", "theft", "medium", False, True),
    ("Small kitchen fire, cabinets and extractor fan damaged.", "fire", "medium", False, False),
    ("Luggage lost on connecting flight, still not returned after 5 days.", "lost_luggage", "medium", False, False),
    ("Flight cancelled, had to pay for an extra hotel night.", "travel_disruption", "low", False, False),
    ("Phone stolen at the train station during the trip.", "theft", "medium", False, True),
    ("Needed a doctor abroad for a stomach infection.", "medical", "medium", False, False),
    ("Emergency room visit after a fall, wrist X-ray and cast.", "medical", "high", True, False),
    ("Physiotherapy sessions after knee surgery.", "medical", "low", False, False),
    ("Dental emergency, broken tooth needed a crown.", "medical", "high", True, False),
    ("Specialist consultation and blood tests.", "medical", "low", False, False),
    ("Rear-ended on the motorway, I have neck pain and went to A&E.", "collision", "high", True, True),
    (
        "Someone hit my parked car and left a note with their number. Scratch on the door.",
        "collision",
        "low",
        False,
        True,
    ),
    ("Lightning struck the house, the TV and router are fried.", "weather", "medium", False, False),
    (
        "Washing machine hose split, water all over the kitchen floor and it is still leaking.",
        "water",
        "high",
        False,
        False,
    ),
    ("Grease fire in the kitchen spread to the ceiling, the fire brigade came.", "fire", "high", False, False),
    ("A tree fell on the car during the storm and crushed the roof.", "weather", "medium", False, False),
    (
        "My son fell off his bike and broke his arm, X-ray and cast at the hospital.",
        "medical",
        "high",
        True,
        False,
    ),
    ("Suitcase arrived two days late with a broken handle.", "lost_luggage", "low", False, False),
    (
        "Train was 3 hours late, missed the connection and had to buy a new ticket.",
        "travel_disruption",
        "low",
        False,
        False,
    ),
    ("Me han robado el móvil en el metro.", "theft", "medium", False, True),
    ("Bag with my passport was stolen from the hotel room.", "theft", "medium", False, True),
]
