"""``python -m gridpulse report|wordcount ...`` (see ``gridpulse.apps``)."""

from gridpulse.apps import main

main()
