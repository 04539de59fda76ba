from fleetlens.cli import main

main()
