from .plans.app import main

main()
