from mixwright.jobs import main

main()
